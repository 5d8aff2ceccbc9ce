"""Surrogates against a plain Python model of the same keyed draw."""

import hashlib
from collections import Counter

import pytest
import regex

from shopstream.llm import pii, queries

MASTER = regex.compile(pii.MASTER)
TITLE = regex.compile("^" + pii._TITLE)
CHECKED = {"phone", "card", "ssn", "iban"}


def kind_of(entity):
    for kind in ("email", "iban", "ssn", "card", "ip", "phone", "person"):
        if regex.fullmatch(pii.PATTERNS[kind], entity):
            return kind
    return "secret"


def canon_of(kind, surface):
    if kind in ("phone", "card", "ssn"):
        return regex.sub("[^0-9]", "", surface)
    if kind in ("email", "given_f", "given_m", "family"):
        return surface.lower()
    return surface.replace(" ", "") if kind == "iban" else surface


def parts_of(text):
    """[(what stands before, kind, spelling)], the rest of the text, and the
    number of parts."""
    out, at = [], 0
    for m in MASTER.finditer(text or ""):
        kind, lead = kind_of(m[0]), text[at:m.start()]
        at = m.end()
        if kind != "person":
            out.append((lead, kind, m[0]))
            continue
        title = TITLE.match(m[0])[0]
        names = m[0][len(title):].split(" ")
        given = "given_f" if title.rstrip(". ") in pii.FEMALE_TITLES else "given_m"
        for j, n in enumerate(names):
            out.append(((lead + title) if j == 0 else " ", given if j == 0 and len(names) == 2 else "family", n))
    return out, (text or "")[at:]


def check_97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10


def draw(key, kind, canon, attempt):
    def sha(*words):
        return hashlib.sha256("\x01".join(words).encode()).hexdigest()

    stream = "".join(sha(key, kind, canon, str(attempt), str(b)) for b in range(len(canon) // 32 + 2))
    octet = [int(stream[i:i + 2], 16) for i in range(0, len(stream), 2)]

    def classwise(text):
        def one(c, b):
            if c in "0123456789":
                return chr(48 + b % 10)
            if regex.match(r"\p{Lu}", c):
                return chr(65 + b % 26)
            return chr(97 + b % 26) if regex.match(r"\p{L}", c) else c
        return "".join(one(c, octet[i]) for i, c in enumerate(text))

    if kind == "email":
        local, domain = canon.split("@", 1)
        return f"{classwise(local)}@mail{str(int(sha(key, 'host', domain)[:8], 16))[:6]}.example.net"
    if kind == "ip":
        return ".".join(map(str, [10 if attempt < 3 else 240 + octet[3] % 15, *octet[:3]]))
    if kind == "card":
        head = canon[0] + classwise(canon[1:-1])
        return next(head + d for d in "0123456789" if luhn(head + d) == luhn(canon))
    if kind in ("phone", "ssn"):
        return canon[0] + classwise(canon[1:])
    if kind == "iban":
        new = classwise(canon[4:])
        return next(x for c in range(2, 99) for x in [f"{canon[:2]}{c:02d}{new}"] if check_97(x) == check_97(canon))
    if kind in ("family", "given_f", "given_m"):
        script = "cyrillic" if regex.search(r"\p{IsCyrillic}", canon) else "latin"

        def syllables(n):
            return "".join(pii.SYLLABLES[script][octet[i] % 32] for i in range(1, n + 1))
        if kind == "family":
            return syllables(3 + attempt).capitalize()
        return pii.GIVEN[script, kind[-1]][octet[0] % 16] + (syllables(attempt + 1) if attempt else "")
    return stream[:len(canon)] if regex.fullmatch("[0-9a-f]+", canon) else classwise(canon)


def drawn_for(entities, key):
    """Surrogate of every (kind, canon): all draw, the smallest of those that
    drew one surrogate keeps it, the others draw again."""
    real = {(k, c.lower()) for k, c in entities}
    table, taken, pending, attempt = {}, set(), sorted(entities, key=lambda e: e[1].encode()), 0
    while pending:
        won = {}
        for k, c in pending:
            s = draw(key, k, c, attempt)
            if (k, s.lower()) not in real and (k, s.lower()) not in taken:
                won.setdefault((k, s.lower()), (c, s))
        taken |= set(won)
        table.update({(k, c): s for (k, _), (c, s) in won.items()})
        pending, attempt = [e for e in pending if e not in table], attempt + 1
    return table, attempt


def dressed(kind, surface, sur):
    if kind in CHECKED:
        it = iter(sur)
        return "".join(next(it) if (c != " " if kind == "iban" else c in "0123456789") else c for c in surface)
    names = kind in ("email", "given_f", "given_m", "family")
    return sur.upper() if names and len(surface) > 1 and surface == surface.upper() else sur


def model(rows, key):
    found = {t: parts_of(t) for _, t in rows}
    table, _ = drawn_for({(k, canon_of(k, s)) for p, _ in found.values() for _, k, s in p}, key)
    out = Counter()
    for i, t in rows:
        p, tail = found[t]
        new = "".join(lead + dressed(k, s, table[k, canon_of(k, s)]) for lead, k, s in p) + tail
        out[i, new if p else t, len(p)] += 1
    return out


IBAN = "DE89 3704 0044 0532 0130 00"


def test_rows_equal_the_model(docs_of, odd_rows):
    rows = odd_rows + [
        (20, f"Mrs. Anna Schmidt, Mr SCHMIDT, Mr Schmidt and Господин Иван Петров; {IBAN}, GB82 WEST 1234 5698 7654 32"),
        (21, "mail A.B@x.org or a.b@X.ORG, 10.0.0.1, 123-45-6789, 4111-1111-1111-1111, token: abcdefABCDEF0123456789"),
        (21, f"key=0123456789abcdef0123 {IBAN.replace(' ', '')} DE00370400440532013000 +49 30 1234 5678 (030) 555-1234")]
    rows += [(100 + i, f"Mr {chr(65 + i % 26)}{'abcdef'[i // 26 % 6]} Li met Frau {chr(75 + i % 9)}o.") for i in range(150)]
    got = pii.replace_entities(docs_of(rows), "some key").collect()
    assert Counter((r.doc_id, r.text, r.n_entities) for r in got) == model(rows, "some key")


def test_query_equals_the_model(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op9_surrogates(spark, sf).collect()
    assert Counter((r.doc_id, r.text, r.n_entities) for r in got) == model(rows, queries.SURROGATE_KEY)
    assert sum(r.n_entities for r in got) > 20


@pytest.mark.parametrize("iban", ["DE89370400440532013000", "GB82WEST12345698765432", "DE00370400440532013000"])
def test_account_numbers_keep_their_check(spark, iban):
    e = spark.createDataFrame([("iban", iban)], "kind string, canon string")
    sur = pii.surrogates(e, "k").first().surrogate
    assert sur != iban and sur[:2] == iban[:2] and check_97(sur) == check_97(iban) and 2 <= int(sur[2:4]) <= 98


def test_rounds_do_not_grow_with_the_names():
    """100,000 given names of one gender: the room grows 32 times a round."""
    table, rounds = drawn_for({("given_f", f"name{i}") for i in range(100_000)}, "k")
    assert len(set(table.values())) == 100_000 and rounds <= 6
