"""SimHash near-dedup, packing and the whole pipeline against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from shopstream.llm import components, packing, simhash
from shopstream.llm.queries import tokenizer_path

from .test_dedup import brute_lines, key
from .test_rules_and_shards import brute_hits


def brute_fp(text, size=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i:i + size]).encode(), 42) for i in range(max(1, len(ws) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """Smallest linked value of each distinct fingerprint (by quadratic search)."""
    values, root = sorted(set(fps)), {}
    for v in values:
        if v in root:
            continue
        todo, root[v] = [v], v
        while todo:
            x = todo.pop()
            for y in values:
                if y not in root and (x ^ y).bit_count() <= 2:
                    root[y] = v
                    todo.append(y)
    return root


def test_golay_keys_meet():
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    one, two = (np.uint64(1) << rng.integers(0, 64, len(fps)).astype(np.uint64) for _ in range(2))
    a, b = simhash.candidate_keys(fps), simhash.candidate_keys(fps ^ one ^ two)
    assert ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any((1, 2)).all()


@pytest.mark.parametrize("small_bucket", [1, 4, 16])
def test_links_connect_all(spark, small_bucket):
    """Crowded neighbourhoods: links connect what brute force connects."""
    rng = np.random.default_rng(small_bucket)
    fps = []
    for center in rng.integers(0, 2**64, 6, dtype=np.uint64):
        for _ in range(40):
            v = int(center)
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                v ^= 1 << int(b)
            fps.append(v)
    fps += [0, 1, 2, 7, 2**64 - 1]
    signed = [v - 2**64 if v >= 2**63 else v for v in fps]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    pairs = simhash.links(df, small_bucket)
    assert all(((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 2 and r.u > r.v for r in pairs.collect())
    roots = {r.node: r.root for r in components.components(pairs).collect()}
    exp, got = brute_components(fps), {}
    for v, s in zip(fps, signed):
        got.setdefault(roots.get(s, s), set()).add(v)
    want = {}
    for v in fps:
        want.setdefault(exp[v], set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain(spark):
    n = 200
    df = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(500, 400)], "u long, v long")
    assert {(r.node, r.root) for r in components.components(df).collect()} == {(i, 0) for i in range(1, n + 1)} | {(500, 400)}


def test_grouped_and_keep_one(spark, docs_of, odd_rows, prose):
    a = prose(400, 77)
    rows = odd_rows + [(40 + i, a + f" ending{i}") for i in range(5)] + [(30, a), (200, "one two"), (201, "ONE  two")]
    got = simhash.grouped(docs_of(rows)).collect()
    fps = {}
    for r in got:
        fps.setdefault(r.fp & (2**64 - 1), []).append(r.doc_id)
    assert Counter((i, brute_fp(t)) for i, t in rows) == Counter((r.doc_id, r.fp & (2**64 - 1)) for r in got)
    roots = brute_components(list(fps))
    least = {}
    for v, ids in fps.items():
        least.setdefault(roots[v], []).extend(i for i in ids if i is not None)
    for r in got:
        ids = least[roots[r.fp & (2**64 - 1)]]
        assert r.component == (min(ids) if ids else None)
    kept = simhash.keep_one(docs_of(rows))
    assert {r.component for r in kept.collect()} == {"component"}
    assert Counter(r.doc_id for r in kept.collect()) == Counter({r.component for r in got})
    assert simhash.grouped(docs_of([])).collect() == [] and simhash.keep_one(docs_of([])).collect() == []


def test_fingerprint_of_a_long_text(prose, monkeypatch):
    text = prose(1000, 4)
    monkeypatch.setattr(simhash, "_CHUNK", 64)
    assert simhash.fingerprint(text) == brute_fp(text)


@pytest.fixture(scope="module")
def reference_tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_engines_agree(reference_tokenizer):
    enc = packing.Encoder(tokenizer_path())
    assert enc.fast
    texts = ["", "a", "<|endoftext|>x", " lead and trail  ", "\n\n\t x\r\n", "don't WE'LL 12345 3.14", "é ñ ß 漢字 🙂🙂", "a" * 5000,
             " " * 3000, "#$" * 500, "  x\u0085y​", "한국어 текст ελληνικά"]
    for t in texts:
        assert enc.encode(t).tolist() == reference_tokenizer.encode(t, add_special_tokens=False).ids


def check_packing(rows, got, tok, window):
    docs = Counter((key(i), tuple(tok.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in rows)
    by_seq, ids = {}, sorted(got, key=lambda r: (r.sequence_id, r.offset))
    for r in got:
        assert r.length == len(r.ids) > 0 and r.offset + r.length <= window
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    last = max(by_seq, default=0)
    assert sorted(by_seq) == list(range(last + 1)) or not got
    for s, parts in by_seq.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == window or s == last
    whole, cur = Counter(), []
    for r in ids:  # documents follow each other in the global order
        assert r.start == len(cur)
        cur += r.ids
        if len(cur) == r.doc_tokens:
            whole[key(r.doc_id), tuple(cur)] += 1
            cur = []
    assert not cur and whole == docs


@pytest.mark.parametrize("window", [16, 2048])
def test_packing(spark, docs_of, odd_rows, reference_tokenizer, window):
    got = packing.pieces(docs_of(odd_rows), tokenizer_path(), window=window)
    check_packing(odd_rows, got.collect(), reference_tokenizer, window)
    assert "shard" in got.columns
    seqs = packing.sequences(got, window).collect()
    assert all(len(r.ids) == window for r in seqs)
    assert sum(r.n_tokens for r in seqs) == sum(r.length for r in got.collect())
    assert packing.pieces(docs_of([]), tokenizer_path()).collect() == []


def test_pipeline(spark, prose, odd_rows, reference_tokenizer, tmp_path):
    passage = prose(30, 1000)
    stop = "the of and "
    rows = [(i, t) for i, t in odd_rows] + [(100 + i, f"{stop * 4}{prose(90, 100 + i)}\nthis line is in many documents of all\n"
                                             + prose(20, 300 + i)) for i in range(12)]
    rows += [(200, stop * 5 + prose(80, 100)), (201, f"{stop * 3}{prose(60, 55)} {passage}"), (202, "too short"),
             (203, stop * 3 + prose(200, 77)), (204, stop * 3 + prose(200, 77) + " end")]
    docs = spark.createDataFrame([(*r, "en", "src0", len(r[1] or "")) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    items = [(1, passage), (2, "short item")]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    state, frame = None, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in frame.collect()]
        frame = corpus_pipeline.materialise(stage(spark, frame, str(tmp_path)), "test-stage")
        assert frame.columns == docs.columns
        after = [(r.doc_id, r.text) for r in frame.collect()]
        if name == "quality_rules":
            assert all(len((t or "").split()) >= 50 for _, t in after)
            assert {i for i, _ in after} >= {*range(100, 112), 201, 203}
        elif name == "line_dedup":
            import hashlib
            assert sorted((key(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in after) == sorted(
                (i, s) for i, _, s in brute_lines(before))
        elif name == "simhash_near_dedup":
            roots = brute_components([brute_fp(t) for _, t in before])
            groups = {}
            for i, t in before:
                groups.setdefault(roots[brute_fp(t)], []).append(i)
            want = Counter(min((i for i in g if i is not None), default=None) for g in groups.values())
            assert Counter(i for i, _ in after) == want and 204 not in {i for i, _ in after}
        else:
            bad = {x[0] for x in brute_hits(before, items) if x[5]}
            assert 201 in bad and Counter(after) == Counter(x for x in before if x[0] not in bad)
        state = after
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = Counter()
    for i, t in state:
        want[key(i)] += len(reference_tokenizer.encode(t, add_special_tokens=False).ids) + 1
    have = Counter()
    for r in got:
        have[key(r.doc_id)] += r.length
    assert have == want
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.collect() == [] or name == "packing"
