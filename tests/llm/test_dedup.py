"""Line, block and suffix dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopstream.llm import block_dedup, exchange, line_dedup, suffix_array, suffix_dedup
from shopstream.session import materialise

NULL = -2**63


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def key(i):
    return NULL if i is None else i


def brute_words(rows, size=20):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in texts:
        for k in range(len(w) - size + 1):
            s = tuple(w[k:k + size])
            first[s] = min(first.get(s, key(i)), key(i))
    out = []
    for i, w in texts:
        gone, own = [False] * len(w), set()
        for k in range(len(w) - size + 1):
            s = tuple(w[k:k + size])
            if first[s] < key(i) or s in own:
                gone[k:k + size] = [True] * size
            own.add(s)
        out.append((key(i), len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out)


def brute_bytes(rows, size=50):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for k in range(len(b) - size + 1):
            s = b[k:k + size]
            first[s] = min(first.get(s, key(i)), key(i))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first[b[k:k + size]] < key(i):
                gone[k:k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((key(i), len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept)))
    return sorted(out)


def brute_lines(rows):
    def k(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(k(line)) >= 20:
                holders.setdefault(k(line), set()).add(key(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(k(x), ())) >= 3 and max(holders[k(x)]) != key(i))]
        out.append((key(i), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out)


def words_result(df):
    return sorted((key(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def bytes_result(df):
    return sorted((key(r.id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def tangled(seed, n=40):
    """Documents cut from few pieces: shared spans of all lengths, runs of one
    character, copies inside a document."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("ab \n") for _ in range(rng.randrange(5, 130))) for _ in range(12)] + ["a" * 90, "a b " * 30]
    return [(rng.randrange(n), "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 6)))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tangled_bytes_and_words(spark, docs_of, seed):
    rows = tangled(seed)
    assert bytes_result(suffix_dedup.repeated_bytes(docs_of(rows))) == brute_bytes(rows)
    assert words_result(block_dedup.repeated_words(docs_of(rows))) == brute_words(rows)


def test_odd_rows(spark, docs_of, odd_rows):
    assert bytes_result(suffix_dedup.repeated_bytes(docs_of(odd_rows))) == brute_bytes(odd_rows)
    assert words_result(block_dedup.repeated_words(docs_of(odd_rows))) == brute_words(odd_rows)


def test_hot_passage_many_shards(spark, prose, monkeypatch):
    """One passage in every document, and shards of a few documents each."""
    from shopstream.llm import exchange
    passage = prose(40, 99)
    rows = [(i, f"{prose(15, i)} {passage} {prose(15, i + 500)}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    assert bytes_result(suffix_dedup.repeated_bytes(df)) == brute_bytes(rows)
    assert words_result(block_dedup.repeated_words(df)) == brute_words(rows)
    assert exchange.Ranges(10**9).count > 1000


def test_empty_table(spark, docs_of):
    assert suffix_dedup.repeated_bytes(docs_of([])).collect() == []
    assert block_dedup.repeated_words(docs_of([])).collect() == []
    assert line_dedup.dedup_lines(docs_of([])).collect() == []


def test_lines(spark, docs_of, odd_rows):
    common = ["  The Same Line Of Some Length\t", "the same line of some length", "another common line, long enough"]
    rows = [(i, "\n".join([common[i % 3], f"own line {i} of this document here", common[(i + 1) % 3], "short"]))
            for i in range(12)] + odd_rows + [(3, common[0]), (99, "\n".join(common))]
    out = line_dedup.dedup_lines(docs_of(rows), n_dropped="n_dropped")
    assert out.columns[-1] == "n_dropped" and "keep" in out.columns
    got = sorted((key(r.doc_id), r.n_dropped, sha(r.text or "")) for r in out.collect())
    assert got == brute_lines(rows)
    assert {r.keep for r in out.collect()} == {"keep"}


@pytest.mark.parametrize("rows_per_range", [1, 3, 40])
def test_lines_of_many_ranges_and_hot_lines(spark, docs_of, odd_rows, rows_per_range):
    """Hot lines, and documents whose rows share an id, spread over sub-ranges."""
    hot = "the line that a third of all rows holds"
    rows = [(i % 25 if i % 3 else None, "\n".join([hot] * (i % 4) + [f"some line number {i % 17} of a few"] * (i % 3)))
            for i in range(90)] + odd_rows
    got = line_dedup.dedup_lines(docs_of(rows), n_dropped="n_dropped", rows_per_range=rows_per_range)
    assert sorted((key(r.doc_id), r.n_dropped, sha(r.text or "")) for r in got.collect()) == brute_lines(rows)


def test_first_occurrences_are_streamed(spark, docs_of):
    """One range exchange and one sort feed both windows; hot lines spread."""
    rows = [(i, "the line that every document holds\nan own line, number %d of them" % i) for i in range(400)]
    lines = line_dedup.keyed_lines(docs_of(rows), "doc_id", "text", 20)
    stream = line_dedup.line_stream(materialise(lines, "test-lines"), 100)
    plan = stream._jdf.queryExecution().sparkPlan().toString()
    prepared = stream._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 2
    windows = prepared[:prepared.index("rangepartitioning")]
    assert windows.count("Sort [") == 1 and "hashpartitioning" not in windows
    sizes = [r["count"] for r in stream.groupBy("rng", "sub").count().collect()]
    assert sum(sizes) == 800 and max(sizes) <= 150
    firsts = {(r.doc, r.n_docs) for r in stream.where("new_doc and not hot").collect()}
    assert firsts == {(i, 1) for i in range(400)}


def test_bitmaps_hold_runs(spark, docs_of):
    line = "a line that three documents share"
    rows = [(i, f"first\n{line}\nmiddle\nlast") for i in (1, 2, 3)]
    maps = {r.doc: (r.n_dropped, [(k.start, k.len) for k in r.keep])
            for r in line_dedup.keep_bitmaps(docs_of(rows)).collect()}
    assert maps == {1: (1, [(0, 1), (2, 2)]), 2: (1, [(0, 1), (2, 2)])}


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=200).map(lambda b: bytes(x % 3 for x in b)))
def test_suffix_array(text):
    a = np.frombuffer(text, np.uint8)
    order, _ = suffix_array.suffix_array(a, len(a))
    assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))
    lcp = suffix_array.common_prefixes(a, order, 50, lanes=7)
    for k in range(1, len(text)):
        x, y = text[order[k - 1]:], text[order[k]:]
        n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert lcp[k] == min(n, 50)


def test_suffix_dedup_cuts_long_texts(docs_of, odd_rows, prose):
    """Texts of many shards, pieces and border parts give what whole ones give."""
    long = prose(2500, 21)
    rows = odd_rows + [(20, long), (21, long[:5000] + "#" + long[5000:]), (22, "a" * 9000), (23, "a" * 7000 + "b"),
                       (24, long[3000:9000] * 2), (25, prose(700, 22)), (26, "\n" * 4096)]
    got = bytes_result(suffix_dedup.repeated_bytes(docs_of(rows), shard_bytes=2000))
    assert got == brute_bytes(rows)


@pytest.mark.parametrize("piece,border", [(64, 100), (999, 300)])
def test_runs_and_borders_do_not_depend_on_pieces(monkeypatch, prose, piece, border):
    text = (prose(300, 31) + "x" * 200 + prose(300, 31)).encode()
    data = np.frombuffer(text, np.uint8)
    off = np.array([0, 0, 100, len(data) // 2, len(data)])
    ids = np.array([4, 5, 6, 7])

    def strings(runs):
        first, second, least, start, group = suffix_dedup._borders(runs, np.arange(len(runs.anchor)), ids)
        return {int(p): (int(first[g]), int(least[g])) for p, g in zip(start, group)}
    whole = strings(suffix_dedup.Runs(data, off, 50, sides=False))
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "BORDER", border)
    assert strings(suffix_dedup.Runs(data, off, 50, sides=False)) == whole
    by = {}
    for p in whole:
        by.setdefault(text[p:p + 50], set()).add(whole[p])
    assert all(len(v) == 1 for v in by.values())


def test_suffix_dedup_of_a_text_of_64_mb_in_bounded_memory():
    """What a worker does with shards of one 64 MB text, piece by piece."""
    import resource
    rng = np.random.default_rng(1)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for k in range(64):
        data = rng.integers(97, 123, 1 << 20).astype(np.uint8) if k % 8 else np.full(1 << 20, 97, np.uint8)
        runs = suffix_dedup.Runs(data, np.array([0, len(data)]), 50)
        assert len(runs.side) > 0
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400 << 10


def test_anchor_keys_spread_over_ranges():
    """Anchors are the smallest hashes of their strings; as keys they must not crowd into the lowest range."""
    data = np.random.default_rng(5).integers(97, 123, 400_000).astype(np.uint8)
    runs = suffix_dedup.Runs(data, np.array([0, len(data)]), 50, sides=False)
    ranges = exchange.Ranges(16 * exchange.RANGE_KEYS)
    sizes = np.diff(ranges.cuts(np.unique(runs.gram), 64))
    assert len(sizes) == 16 and sizes.max() < 1.2 * sizes.mean()
