"""Order of calls by their dependencies against a plain longest-path model."""

import random

import pytest

from shopstream.llm import tool_calls

LINKED = "conv_id long, call_id string, turn long, after array<string>, status string"


def model(calls):
    """{call: layer}, None in or behind a cycle; calls maps a call to (turn, after)."""
    deps = {c: {d for d in after if d in calls} for c, (_, after) in calls.items()}
    layers, left = {}, set(calls)
    while True:
        ready = [c for c in left if all(d in layers for d in deps[c])]
        if not ready:
            return {**layers, **{c: None for c in left}}
        for c in ready:
            layers[c] = max([layers[d] + 1 for d in deps[c]], default=0)
        left -= set(ready)


def by_turn(calls):
    return all(calls[d][0] < turn for turn, after in calls.values() for d in after if d in calls)


def layers_of(spark, logs):
    rows = [(conv, c, turn, after, "no_result") for conv, calls in logs.items() for c, (turn, after) in calls.items()]
    layers, unknown = tool_calls.dependency_layers(spark.createDataFrame(rows, LINKED).repartition(3))
    got = {}
    for r in layers.collect():
        got.setdefault(r.conv_id, {})[r.call_id] = r.layer
    return got, {(r.conv_id, r.call_id) for r in unknown.collect()}


@pytest.mark.parametrize("most", [tool_calls.MOST_BYTES, 1000, 0])
def test_random_logs(spark, monkeypatch, most):
    """In one task each, in rounds of joins, and some by either."""
    monkeypatch.setattr(tool_calls, "MOST_BYTES", most)
    rng = random.Random(7)
    logs = {None: {None: (1, ["z"]), "z": (2, [])}}
    for conv in range(60):
        n, many, back = rng.randint(1, 14), rng.randint(1, 4), rng.random() < 0.4
        logs[conv] = {f"c{i}": (rng.randrange(n), [f"c{rng.randrange(n + 2) if back else rng.randrange(i + 1, n + 2)}"
                                                   for _ in range(rng.randrange(many))]) for i in range(n)}
    got, unknown = layers_of(spark, logs)
    assert got == {conv: model(calls) for conv, calls in logs.items() if not by_turn(calls)}
    assert unknown == {(conv, c) for conv, calls in logs.items() for c, (_, after) in calls.items()
                       if any(d not in calls for d in after)}
    kinds = {layer is None for layers in got.values() for layer in layers.values()}
    assert kinds == {True, False} and max(x or 0 for layers in got.values() for x in layers.values()) > 3


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """700 calls, each after the next one; a third name a common call too."""
    n, rounds = 700, []
    write = tool_calls.materialise
    monkeypatch.setattr(tool_calls, "MOST_BYTES", 0)
    monkeypatch.setattr(tool_calls, "materialise", lambda df, name: rounds.append(name) or write(df, name))
    calls = {f"c{i}": (i, [f"c{i + 1}"] + ([f"c{n}"] if i % 3 == 0 else [])) for i in range(n)}
    calls[f"c{n}"] = (n, [])
    loop = {"a": (0, ["b"]), "b": (1, ["c"]), "c": (2, ["a"]), "d": (3, ["c"]), "e": (4, [])}
    got, _ = layers_of(spark, {1: calls, 2: loop})
    assert got[1] == {f"c{i}": n - i for i in range(n + 1)}
    assert got[2] == {"a": None, "b": None, "c": None, "d": None, "e": 0}
    assert rounds.count("call-state") <= 13
