"""Quality rules, sharding, decontamination, surrogates, tool calls."""

import hashlib
import json
import re
import zlib
from collections import Counter

from shopstream.llm import decontaminate, pii, quality, sharding, tool_calls


def brute_quality(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    win = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    times = Counter(win)
    hit = {i + j for i, w in enumerate(win) if times[w] > 1 for j in range(3)}
    base = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
    return (*base, base[0] < 50 or 100 * len(hit) > 50 * len(ws))


def test_quality(spark, docs_of, odd_rows, prose):
    rows = odd_rows + [(20, "of the and " * 30), (21, " ".join(f"w{i}### ok" for i in range(60))),
                       (22, "a b c a b c d e a b"), (23, "of the " + prose(80, 5) + "\n\n of \nof"), (24, "wörter der " * 40)]
    got = quality.score(docs_of(rows).drop("kept", "n_words")).collect()
    for r in got:
        exp = brute_quality(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == exp, r.doc_id
        assert not (r.kept and r.base_failed)
    by = {r.doc_id: r for r in got}
    assert by[21].broken_rules and not by[21].kept and not by[21].base_failed
    assert by[23].kept and by[23].shard == "shard"
    kept = quality.keep_good(docs_of(rows))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}
    assert {r.kept for r in kept.collect()} == {"kept"}
    assert quality.score(docs_of([])).collect() == []


def shard_rows(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return sharding.assign_shards(df, 4, **kw).collect()


def test_sharding(spark, odd_rows, prose):
    rows = odd_rows + [(100 + i, prose(20 + i % 90, i)) for i in range(300)]
    out = shard_rows(spark, rows)
    size = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.id, r.size, r.text_crc32) for r in out) == size
    total = Counter()
    for s in range(4):
        mine = sorted(r.slot for r in out if r.shard == s)
        assert mine == list(range(len(mine)))
        total[s] = sum(r.size for r in out if r.shard == s)
    assert max(total.values()) - min(total.values()) <= 2 * max(r.size for r in out)
    assert sharding.assign_shards(spark.createDataFrame([], "doc_id long, text string"), 4).collect() == []


def test_sharding_hot_group(spark, prose):
    """Equal rows that fill more than a shard are split; small groups are not."""
    rows = [(7, prose(40, 1))] * 300 + [(1000 + i, prose(30, 2 + i // 3)) for i in range(300)]
    out = shard_rows(spark, rows)
    sums = [sum(r.size for r in out if r.shard == s) for s in range(4)]
    assert max(sums) - min(sums) < 0.1 * sum(sums) / 4
    small = {}
    for r in out:
        if r.id != 7:
            small.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in small.values()) <= 3 * 2


def words(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(docs, items, n=13):
    out = []
    for i, t in docs:
        ws, hit, ids = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            size = min(n, len(iw))
            wins = {tuple(iw[k:k + size]) for k in range(len(iw) - size + 1)} if iw else set()
            at = [k for k in range(len(ws) - size + 1) if tuple(ws[k:k + size]) in wins] if iw else []
            hit |= {k + j for k in at for j in range(size)}
            if at and item is not None:
                ids.add(str(item))
        out.append((i, len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


def test_decontamination(spark, docs_of, odd_rows, prose):
    items = [(1, prose(40, 7)), (2, prose(13, 8)), (3, "One, two THREE four"), (10, prose(40, 7)), (4, None), (5, "..."),
             (6, "solo"), (7, "x y x y x y x y x y x y x y x y"), (None, prose(20, 11)), (8, "öl"), (1, prose(15, 12))]
    p = words(items[0][1])
    rows = odd_rows + [
        (50, prose(30, 20) + " " + " ".join(p[5:25]).upper() + ". " + prose(30, 21)), (51, " ".join(p[3:15])),
        (52, "zero one-two three; four five"), (53, "x y " * 30), (54, prose(2000, 30) + " " + " ".join(p)),
        (55, "solo Öl öl ÖL"), (56, items[8][1]), (57, " ".join(p[:13] + ["gap"] + p[13:30]))]
    df = spark.createDataFrame(items, "item_id long, text string")
    for limit in (2_000_000, 20):  # one block of items, and several
        out = decontaminate.judged(docs_of(rows), df, block_words=limit)
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out.collect()), key=str)
        assert got == brute_hits(rows, items)
    left = decontaminate.clean(docs_of(rows), df)
    assert {r.n_words for r in left.collect()} == {"n_words"}
    assert Counter(r.doc_id for r in left.collect()) == Counter(x[0] for x in brute_hits(rows, items) if not x[5])
    assert decontaminate.judged(docs_of([]), df).collect() == []
    none = decontaminate.judged(docs_of(rows), df.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)


def test_surrogates(spark, docs_of, odd_rows):
    rows = [(1, "Call +1 (017) 555-7713 or mail Die.55@mail4.example.com, ip 97.51.17.173 card 4111 1111 1111 1111."),
            (2, 'die.55@MAIL4.example.com Mrs. Anna Schmidt met Mr Schmidt, Господин Иванов; token = "04dbebab91ab8568"'),
            (2, "4111111111111111 DE89 3704 0044 0532 0130 00 123-45-6789 and +1 (017) 555-7713"),
            (30, "plain text 123 and 1.2.3, figures 3.14 and 2024")] + odd_rows
    out = pii.replace_entities(docs_of(rows), "k")
    got = {}
    for r in out.collect():
        got.setdefault((r.doc_id, r.n_entities > 0), []).append(r)
    one, = got[1, True]
    m = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3}-\d{4}) or mail (\S+@\S+\.net), ip ([\d.]+) card ((?:\d{4} ){3}\d{4})\.", one.text)
    assert m and one.n_entities == 4 and one.kept == "kept"
    card = m[5].replace(" ", "")
    assert card != "4111111111111111" and card[0] == "4"
    assert sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(card))) % 10 == 0
    a, b = sorted(got[2, True], key=lambda r: "Mrs" not in r.text)
    assert a.text.startswith(m[3]) and card in b.text and f"({m[1]}) {m[2]}" in b.text
    names = re.search(r"Mrs\. (\w+) (\w+) met Mr (\w+), Господин (\w+); token = \"([0-9a-f]{16})\"", a.text)
    assert names[2] == names[3] and names[1] in pii.GIVEN["latin", "f"] and re.fullmatch("[А-Яа-я]+", names[4])
    for secret in ("97.51.17.173", "Schmidt", "04dbebab", "123-45-6789", "3704", "555-7713"):
        assert not any(secret in (r.text or "") for r in out.collect())
    clean = Counter((i, t) for i, t in rows if i not in (1, 2) or t in (odd_rows[0][1], None, odd_rows[-1][1]))
    assert Counter((r.doc_id, r.text) for r in out.collect() if not r.n_entities) == clean
    assert pii.replace_entities(docs_of([]), "k").collect() == []


def test_surrogates_stay_distinct(spark):
    """Many entities of a kind with little room: collisions draw again."""
    ids = [(i, f"Mr {chr(65 + i % 26)}{'abcdefghij'[i // 26 % 10]}{'xyz'[i // 260]}") for i in range(700)]
    e = spark.createDataFrame([("given_m", t[3:].lower()) for _, t in ids], "kind string, canon string")
    table = pii.surrogates(e, "k").collect()
    assert len(table) == len({r.surrogate for r in table}) == 700


CALL = "conv_id long, call_id string, turn long, name string, arguments string, after array<string>"
RESULT = "conv_id long, call_id string, turn long, content string"


def test_tool_calls(spark):
    tools = {"add": {"type": "object", "required": ["a"], "additionalProperties": False,
                     "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["string", "null"], "enum": ["x", None]}}},
             "say": {"properties": {"t": {"type": "array", "items": {"type": "string", "maxLength": 2}}}}}
    calls = [(1, "a", 1, "add", '{"b":"x", "a":1.0}', []), (1, "a", 1, "add", '{"b":"x", "a":1.0}', []),
             (1, "b", 3, "say", '{"t":["ok","long"]}', ["a"]), (1, "c", 5, "add", '{"a":-1,"z":0}', ["b", "nope"]),
             (2, "x", 5, "add", '{"a":1,"a":2}', []), (2, "y", 1, "add", "nonsense", ["x"]), (2, "z", 2, "add", None, ["y"]),
             (3, "p", 1, "huh", "{}", ["q"]), (3, "q", 2, "say", '{"t":["é\\u00fc"]}', ["p"]), (3, "r", 3, "say", "{}", ["q"]),
             (3, "s", 4, "say", '{"k":"\\ud800"}', []), (None, None, None, "add", '{"a":0,"b":null}', None)]
    results = [(1, "a", 2, "three"), (1, "b", 2, None), (1, "lost", 9, "?"), (2, "x", 6, "1"), (2, "x", 7, "2"),
               (None, None, None, "nulls")]
    out = tool_calls.formatted(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT),
                               spark.createDataFrame([(k, json.dumps(v)) for k, v in tools.items()], "name string, schema string"))
    got = {(r.conv_id, r.call_id): r for r in out.collect()}
    assert len(got) == 12
    a = got[1, "a"]
    assert (a.position, a.status, a.valid, a.n_calls) == (1, "linked", True, 2)
    assert a.message == '{"arguments":{"a":1,"b":"x"},"call_id":"a","name":"add","result":"three"}'
    b = got[1, "b"]
    assert (b.position, b.status, b.errors) == (2, "early_result", ["$.t[1]: maxLength"])
    assert got[1, "c"].errors == ["$.a: minimum", "$.z: not allowed", "unknown dependency"]
    assert got[1, "c"].status == "no_result" and got[1, "lost"].status == "orphan_result"
    assert [got[2, k].position for k in "xyz"] == [1, 2, 3]  # by dependency, not by turn
    assert got[2, "x"].errors == ["repeated key"] and got[2, "x"].n_results == 2
    assert got[2, "y"].errors == ["not JSON"] and got[2, "z"].errors == ["no arguments"]
    assert {got[3, k].status for k in "pqr"} == {"cycle"} and got[3, "s"].status == "no_result"
    assert got[3, "p"].errors == ["unknown tool"] and "éü" in got[3, "q"].message and "\\ud800" in got[3, "s"].message
    assert got[None, None].status == "linked" and got[None, None].valid
    empty = tool_calls.formatted(spark.createDataFrame([], CALL), spark.createDataFrame([], RESULT),
                                 spark.createDataFrame([], "name string, schema string"))
    assert empty.collect() == []
