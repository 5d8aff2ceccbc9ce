"""Shards against a plain Python model with the same splitters."""

from bisect import bisect_right
from collections import defaultdict

import pytest

from shopstream.llm import sharding
from shopstream.session import materialise


def model(records, bounds, shards, whole_group):
    """{k3: (shard, slot)} of (k1, k2, k3, size) records: walk them in order,
    place each by the running total at its middle, a small group of equal
    texts inside one range by the group's middle."""
    total = sum(r[3] for r in records)
    ranges = defaultdict(list)
    for r in sorted(records):
        ranges[bisect_right(bounds, r[:3])].append(r)
    out, slots, offset = {}, defaultdict(int), 0
    for rng in sorted(ranges):
        end, ends, group = 0, {}, defaultdict(list)
        for r in ranges[rng]:
            end += r[3]
            ends[r[2]] = end
            group[r[0]].append(r)
        placed = []
        for r in ranges[rng]:
            g = group[r[0]]
            size = sum(x[3] for x in g)
            if size * shards <= total * whole_group:
                at = ends[g[-1][2]] - size // 2
            else:
                at = ends[r[2]] - r[3] // 2
            placed.append((min((offset + at) * shards // total, shards - 1), r))
        for shard, r in placed:
            out[r[2]] = (shard, slots[shard])
            slots[shard] += 1
        offset += end
    return out


@pytest.mark.parametrize("shards,whole_group", [(4, 0.02), (7, 0.5), (3, 0.0)])
def test_assignment_equals_the_model(spark, odd_rows, prose, monkeypatch, shards, whole_group):
    rows = odd_rows + [(100 + i, prose(20 + i % 90, i)) for i in range(300)]
    rows += [(1000 + i, prose(30, 1)) for i in range(160)] + [(2000 + i, prose(25, i % 20)) for i in range(60)]
    docs = materialise(spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'a' AS shard", "1 AS slot", "2 AS size", "'b' AS rng", "'c' AS k1").repartition(5), "shard-docs")
    seen = []

    def noted(keys, ranges, sample, whole=sharding.splitters):
        seen.append(([tuple(r) for r in keys.select(*sharding.KEY, "size").collect()], whole(keys, ranges, sample)))
        return seen[-1][1]

    monkeypatch.setattr(sharding, "splitters", noted)
    out = sharding.assign_shards(docs, shards, whole_group=whole_group).collect()
    (records, bounds), = seen
    assert len(bounds) > shards and bounds == sorted(bounds)
    assert {r.k3: (r.shard, r.slot) for r in out} == model(records, bounds, shards, whole_group)
    assert len(out) == len(rows)
