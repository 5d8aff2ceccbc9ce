"""Operators 11 to 13 against plain Python on small fixtures."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopstream.llm import bitplanes, divergence, prefix_hash


# ------------------------------------------------------- 11: centroid clustering

def lloyd(rows, k=8, rounds=10):
    """Plain integers, no planes."""
    kept = [(i, [math.floor(1024 * x) for x in v], v) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    kept = [r for r in kept if max(map(abs, r[1])) <= bitplanes.LIMIT]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    cents = [r[1] for r in sorted(kept, key=lambda r: (name(r[0]), r[2]))[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(v):
        return min((dist(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        member = [nearest(v)[1] for _, v, _ in kept]
        cents = [[sum(col) // len(col) for col in zip(*mine)]
                 if (mine := [v for (_, v, _), m in zip(kept, member) if m == j]) else c
                 for j, c in enumerate(cents)]
    out = [(i, *nearest(v)[::-1]) for i, v, _ in kept]
    per, total = Counter(), sum(d for _, _, d in out)
    for _, j, d in out:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, per[j], total, sha[j]) for i, j, d in out), key=str)


def ours(df):
    cols = ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in bitplanes.clustered(df).select(*cols).collect()), key=str)


def vectors(spark, rows, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.selectExpr("*", "'x' AS id", "'y' AS cluster", "'z' AS planes").repartition(3)


def test_centroids_equal_plain_rounds(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(64)]) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (200, [0.0] * 64), (201, [-1e-9] * 64),
             (202, None), (203, [1.0] * 63), (204, [None] + [1.0] * 63), (205, [math.nan] * 64),
             (206, [math.inf] + [0.0] * 63), (207, []), (208, [100000.0, -131072.0] + [0.5] * 62)]
    assert ours(vectors(spark, rows)) == lloyd(rows)


def test_centroids_of_few_and_no_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert ours(vectors(spark, rows)) == lloyd(rows)
    assert ours(vectors(spark, [(1, None)])) == []
    assert bitplanes.clustered(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vector_out_of_range_has_a_row_of_nulls(spark):
    rows = [(1, [1.0] * 64), (2, [1e30] + [0.0] * 63), (3, [1e308] * 64), (4, [2.0] * 64)]
    got = ours(vectors(spark, rows))
    assert [r for r in got if r[0] in (2, 3)] == [(2, *[None] * 5), (3, *[None] * 5)]
    assert [r for r in got if r[0] in (1, 4)] == lloyd([rows[0], rows[3]])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 27), st.integers(0, 2**32))
def test_planes_give_exact_products(bits, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-2**bits, 2**bits + 1, (9, 64))
    c = rng.integers(-2**bits // 2, 2**bits // 2 + 1, (4, 64))
    px, pc = (bitplanes.to_planes(v, bitplanes.width_of(v)) for v in (x, c))
    assert (bitplanes.dots(px, pc) == x @ c.T).all()
    assert (bitplanes.norms(px) == (x * x).sum(axis=1)).all()
    assert (bitplanes.bit_sums(px) == x.sum(axis=0)).all()


# --------------------------------------------------- 12: source divergence audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_audit(rows, top=200):
    docs = [(la or "", so or "", TERM.findall((t or "").translate(LOWER))) for t, la, so in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, ws in mine for t in set(ws))
        kept = [t for t, n in df.items() if n >= 3]
        total = Counter(t for _, _, ws in mine for t in ws if df[t] >= 3)
        per = {s: Counter() for _, s, _ in mine}
        for _, s, ws in mine:
            per[s].update(t for t in ws if df[t] >= 3)
        price = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for s, c in per.items():
            pairs = [(-sum(f(price(c, t), price(o, t)) for t in kept), h) for h, o in per.items() if h != s]
            terms = [(-f(price(c, t), price(total, t)), t) for t in kept if c[t] and price(c, t) > price(total, t)]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, x, -v, r) for r, (v, x) in enumerate(found, 1) if part == "pair" or r <= top]
    return sorted(out)


def table_of(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    return df.selectExpr("*", "'a' AS term", "'b' AS n", "1 AS docs", "'c' AS g").repartition(3)


def audited(spark, rows, **kw):
    got = divergence.audit(table_of(spark, rows), **kw)
    return sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, docs=80, sources=6):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["É", "éa", "Straße"]
    return [(" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=rng.randrange(60))),
             rng.choice(["en", "de"]), f"s{rng.randrange(sources)}") for _ in range(docs)]


def test_audit_equals_plain_counts(spark):
    rows = corpus(1) + [(None, "en", "void"), ("", "en", None), ("one two", "fr", "s1"), ("one three", "fr", "s2"),
                        ("Word WORD word-word", None, None), ("word", None, "s1"), ("word a", "", "s1"), ("12 34", "xx", "s")]
    rows += [rows[0]] * 5
    assert audited(spark, rows) == plain_audit(rows)
    assert audited(spark, rows, top=2) == plain_audit(rows, top=2)


def test_audit_with_many_group_blocks_and_tiles(spark):
    rows = corpus(2, docs=60, sources=7)
    assert audited(spark, rows, term_block=16, group_block=2) == plain_audit(rows)


def test_audit_of_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_joint_prices_do_not_depend_on_halving(monkeypatch):
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 40, (500, 5)) * rng.integers(0, 2, (500, 5))
    totals = [int(x) for x in counts.sum(axis=0)]
    whole = divergence.joint_prices(counts, totals, 700)
    monkeypatch.setattr(divergence, "COLUMNS", 16)
    assert (divergence.joint_prices(counts, totals, 700) == whole).all()
    p = [1 + 10**9 * (counts[:, g].astype(object) + 1) // (totals[g] + 700) for g in range(5)]
    assert whole[1, 2] == sum((x - y) ** 2 // y for x, y in zip(p[1], p[2]))


def test_terms_of_long_texts_come_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    for text in ("", "a", "abcdefghijklmnop", "ab cdefgh 12 ijklmnopqr,st é Éx" * 5, " " * 30, "abcdefg hijk"):
        got = [t.decode() for piece in divergence.term_pieces(text) for t in piece]
        assert got == TERM.findall(text.translate(LOWER))


# ------------------------------------------------------ 13: document fingerprints

def run_edits(df):
    return prefix_hash.edited(df).collect()


def plain_edits(rows):
    """(id, n, sha of the edited text) in descending id order, ties aside."""
    rows = sorted(rows, key=lambda r: -math.inf if r[0] is None else r[0], reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        new = t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), prefix_hash.fingerprint(t),
                    prefix_hash.fingerprint(new)))
    return sorted(out, key=str)


def test_edits_equal_plain_neighbours(spark, docs_of, prose):
    rows = [(i * 7 % 101, prose(5 + i * 3 % 40, i)) for i in range(90)]
    rows += [(500, None), (501, ""), (502, "é\U0001F600x" * 9), (None, "last of all"), (-5, "z" * 5000), (503, "ab")]
    got = run_edits(docs_of(rows))
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain_edits(rows)
    assert all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in got)


def test_edits_of_repeated_ids_single_rows_and_none(spark, docs_of, odd_rows):
    assert len(run_edits(docs_of(odd_rows))) == len(odd_rows)
    (one,) = run_edits(docs_of([(1, "abcdef")]))
    assert (one["n_chars"], one["near_next"], one["edited_sha256"]) == (6, 1.0, hashlib.sha256(b"abcdab").hexdigest())
    assert prefix_hash.edited(docs_of([], extra=False)).count() == 0


def test_equal_texts_have_equal_fingerprints_and_likeness_one(prose):
    a, b = prose(300, 1), prose(300, 2)
    assert prefix_hash.fingerprint(a) == prefix_hash.fingerprint(a[:100] + a[100:])
    fa, fb = prefix_hash.fingerprint(a), prefix_hash.fingerprint(b)
    assert prefix_hash.likeness(fa, fa) == 1.0 and prefix_hash.likeness(fa, fb) < 0.1
    cut = len(a) - len(a) // 3
    edited = prefix_hash.fingerprint(a[:cut] + b[:len(a) // 3])
    assert 0.6 <= prefix_hash.likeness(fa, edited) <= 0.67
    middle = prefix_hash.fingerprint(a[:900] + "an insertion" + a[900:])  # both ends are shared
    assert prefix_hash.likeness(fa, middle) > 0.9
    empty = prefix_hash.fingerprint("")
    assert prefix_hash.likeness(empty, empty) == 1.0 and prefix_hash.likeness(empty, fa) == 0.0
    assert prefix_hash.fingerprint("\0") != prefix_hash.fingerprint("\0\0") != empty


def test_likeness_is_symmetric_and_below_one_for_unequal_texts():
    texts = ["", "a", "b", "ab", "abc" * 40, "abc" * 41, "x" * 31, "x" * 32, "x" * 33, "x" * 65, "y" + "x" * 64]
    prints = [prefix_hash.fingerprint(t) for t in texts]
    for i, x in enumerate(prints):
        for j, y in enumerate(prints):
            v = prefix_hash.likeness(x, y)
            assert v == prefix_hash.likeness(y, x) and (v == 1.0) == (i == j)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=60), st.text("ab", max_size=60), st.data())
def test_span_equality_and_extensions(x, y, data):
    p, q = prefix_hash.Prefixes(x), prefix_hash.Prefixes(y)
    a, b = data.draw(st.integers(0, len(x))), data.draw(st.integers(0, len(y)))
    n = data.draw(st.integers(0, 60))
    same = a + n <= len(x) and b + n <= len(y) and x[a:a + n] == y[b:b + n]
    assert p.same_span(a, q, b, n) == same
    shared = 0
    while a + shared < len(x) and b + shared < len(y) and x[a + shared] == y[b + shared]:
        shared += 1
    assert p.extension(a, q, b) == shared


def test_pieces_do_not_change_hashes(monkeypatch, prose):
    text = prose(400, 9) + "\U0001F600é"
    whole, other = prefix_hash.fingerprint(text), prefix_hash.common_prefix(text, text[:1500] + "!")
    monkeypatch.setattr(prefix_hash, "PIECE", 100)
    assert prefix_hash.fingerprint(text) == whole
    assert prefix_hash.common_prefix(text, text[:1500] + "!") == other == 1500
    with pytest.raises(ValueError):
        prefix_hash.Prefixes(text)


def test_megabyte_texts(spark, docs_of):
    rows = [(1, "a" * 1_000_000), (2, "\n" * 1_000_000), (3, "a" * 999_999 + "b")]
    got = {r["doc_id" if "doc_id" in r else "id"]: r for r in run_edits(docs_of(rows))}
    assert got[3]["common_next"] == 0 and got[1]["common_next"] == 999_999
    assert got[1]["near_next"] > 0.9 and got[1]["near_edited"] > 0.9
