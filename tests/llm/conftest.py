import pytest

from tests.conftest import spark  # noqa: F401


@pytest.fixture(scope="session")
def docs_of(spark):  # noqa: F811
    """Documents from (doc_id, text) rows, dealt over three partitions, with
    extra columns whose names clash with the operators' own."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            for c in ("shard", "kept", "fp", "component", "n_words", "keep", "tid", "start", "at", "part_offset"):
                df = df.selectExpr("*", f"'{c}' AS {c}")
        return df.repartition(3) if rows else df
    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau phi".split()


@pytest.fixture(scope="session")
def prose():
    """Deterministic prose of n words."""
    import random

    def make(n, seed):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))
    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Null and empty texts, null ids, repeated rows, ties, a long text."""
    a, b = prose(120, 1), prose(60, 2)
    return [(1, a), (1, a), (2, None), (3, ""), (None, b), (None, b), (4, b), (5, prose(3000, 3) + "\n" + a),
            (6, " \t\n "), (7, "x"), (8, a + " tail"), (9, a.upper()), (10, "é" * 70 + "\n" + "é" * 70), (1, b)]
