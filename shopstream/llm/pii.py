"""Personal data: keyed, type-consistent surrogates for detected entities.

1. Detection: one regular expression finds secrets, email addresses, IBANs,
   card numbers, phone and social security numbers, IPv4 addresses and titled
   person names. Every found entity becomes one or two parts (a name has a
   given and a family part) with a kind and a canonical form, so that
   spellings of one entity (case of an address, layout of a number) stay one.
2. Surrogates: each distinct (kind, canonical form) of the corpus gets a
   surrogate drawn from a keyed SHA-256 stream: digits for digits, letters for
   letters, the first digit of numbers, the Luhn sum of card numbers, country and
   remainder by 97 of IBANs kept, names from the pool of the same gender and script. A title fixes the
   gender.
3. Collision check: a surrogate must differ from every other surrogate and
   from every real entity of its kind. Of entities that drew the same one the
   smallest keeps it and the others draw again with the next attempt, until
   none is left. So distinct entities stay distinct, and one entity has one
   surrogate everywhere.
4. Replacement: texts with entities are joined with their surrogates, which
   take over layout and case of the spelling they replace.

Plan: texts without entities never move. Entities are counted per distinct
form with partial aggregates before any shuffle, and the join that brings
surrogates to occurrences is a plain equi-join (a hot entity's partition is
split by adaptive execution). All of it is DataFrame expressions.

Defined results: null and empty texts stay as they are with no entities; equal
rows get equal results; rows that share an id keep their own texts; of a chain
of labels behind an @ the first 127 are the address; secrets are replaced
whatever their length; all other columns pass through; ``n_entities`` replaces a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from .common import let, same, spare

# Titles by the gender they state.
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Госпожа")
MALE_TITLES = ("Mr", "Herr", "Señor", "Monsieur", "Господин")

# Given names and name syllables by script.
GIVEN = {
    ("latin", "f"): "Ada Berta Clara Dora Emma Frida Greta Hanna Ida Jana Klara Lena Maria Nina Olga Paula".split(),
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jakob Karl Leo Martin Noel Oskar Paul".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса София".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Семён".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa ga ka ke ko la le lo ma me mo na ne no pa ra re ro sa se so ta te to va vo".split(),
    "cyrillic": "ба бе бо ва во га да де до за ка ко ла ле ло ма ме мо на не но па ра ре ро са се со та те то фа".split(),
}

_TITLE = "(?:" + "|".join(FEMALE_TITLES + MALE_TITLES) + r")\.? "
_INITIALS = "".join(sorted({t[0] for t in FEMALE_TITLES + MALE_TITLES}))
_NAME = r"\p{Lu}\p{Ll}{1,30}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: One pattern per kind; tried in this order at each place of a text.
PATTERNS = {
    "secret": r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z0-9+/_\-]{16})"
              r"""(?<=(?i:token|secret|password|passwd|api_key|apikey|key)[ ]{0,2}[=:][ ]{0,2}["']{0,1})"""
              r"[A-Za-z0-9+/_\-]++",
    # possessive groups are matched in a loop, others by recursion; a name has at most 127 labels
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++){1,126}+",
    "iban": r"(?=[A-Z]{2}[0-9])(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z]{4})?(?: ?[0-9]{4}){2,7}"
            r"(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"(?=[0-9])(?<![\p{N}\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}\-])",
    "card": r"(?=[0-9])(?<!\p{N})(?:[0-9]{13,19}|[0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4}[ \-][0-9]{1,7})(?!\p{N})",
    "ip": rf"(?=[0-9])(?<![\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\p{{N}}|\.\p{{N}})",
    "phone": r"(?=[0-9+(])(?<![\p{N}+])(?:(?:\+?[0-9]{1,3}[ .\-]?)?\([0-9]{2,4}\)[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,4}"
             r"|\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){3,4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4})(?!\p{N})",
    "person": rf"(?=[{_INITIALS}])(?<!\p{{L}}){_TITLE}{_NAME}(?: {_NAME})?",
}
MASTER = "|".join(PATTERNS.values())
#: What every entity holds or stands behind; spares most texts the full search.
HINT = rf"[0-9@=:]|(?=[{_INITIALS}]){_TITLE}"
KINDS = (*PATTERNS, "given_f", "given_m", "family")


def _kind(entity: Column) -> Column:
    """The kind of a found entity, seen alone (so without what stands around
    it); secrets are what no other pattern matches whole."""
    out = None
    for kind in ("email", "iban", "ssn", "card", "ip", "phone", "person"):
        cond = entity.rlike(f"^(?:{PATTERNS[kind]})$")
        out = F.when(cond, F.lit(kind)) if out is None else out.when(cond, F.lit(kind))
    return out.otherwise(F.lit("secret"))


def _canon(kind: Column, surface: Column) -> Column:
    digits = F.regexp_replace(surface, "[^0-9]", "")
    return (F.when(kind.isin("phone", "card", "ssn"), digits)
            .when(kind.isin("email", "given_f", "given_m", "family"), F.lower(surface))
            .when(kind == "iban", F.regexp_replace(surface, " ", "")).otherwise(surface))


PART = "struct<lead:string,kind:string,surface:string>"


def parts(text: Column) -> Column:
    """Entities of a text in order: what stands before each part, its kind and
    its spelling. The text behind the last entity is not included."""
    def split_up(e: Column, i: Column, pieces: Column) -> Column:
        lead, kind = F.get(pieces, i), _kind(e)
        one = F.array(F.struct(lead.alias("lead"), kind.alias("kind"), e.alias("surface")))
        title = F.regexp_extract(e, f"^{_TITLE}", 0)
        names = F.split(F.substr(e, F.length(title) + 1), " ")
        given = F.when(F.regexp_replace(title, r"[. ]+$", "").isin(*FEMALE_TITLES), F.lit("given_f")).otherwise(
            F.lit("given_m"))
        two = F.transform(names, lambda n, j: F.struct(
            F.when(j == 0, F.concat(lead, title)).otherwise(F.lit(" ")).alias("lead"),
            F.when((j == 0) & (F.size(names) == 2), given).otherwise(F.lit("family")).alias("kind"),
            n.alias("surface")))
        return F.when(kind == "person", two).otherwise(one)

    found = F.regexp_extract_all(text, F.lit(MASTER), F.lit(0))
    return let(F.split(text, MASTER, -1), lambda pieces: F.flatten(
        F.transform(found, lambda e, i: split_up(e, i, pieces))))


def _stream(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """Keyed hex digits, two for every character of the canonical form."""
    blocks = F.sequence(F.lit(0), F.floor(F.length(canon) / 32).cast("int") + 1)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws(
        "\u0001", F.lit(key), kind, canon, attempt.cast("string"), b.cast("string")), 256)), "")


def _byte(stream: Column, i: Column) -> Column:
    """The i-th byte (from 0) of a hex stream."""
    return F.conv(F.substr(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _classwise(text: Column, stream: Column) -> Column:
    """Each digit, lower and upper letter replaced within its class."""
    def one(c: Column, b: Column) -> Column:
        return (F.when(c.rlike("[0-9]"), F.char(F.lit(48) + b % 10))
                .when(c.rlike(r"\p{Lu}"), F.char(F.lit(65) + b % 26))
                .when(c.rlike(r"\p{L}"), F.char(F.lit(97) + b % 26)).otherwise(c))

    def all_of(hexes: Column) -> Column:  # an array, so that each byte is found at once
        return F.transform(_chars(text), lambda c, i: one(
            c, F.conv(F.concat(F.get(hexes, 2 * i), F.get(hexes, 2 * i + 1)), 16, 10).cast("int")))
    return F.array_join(let(_chars(stream), all_of), "")


def _numbers(canon: Column, stream: Column) -> Column:
    """New digits behind the first."""
    return F.concat(F.substr(canon, F.lit(1), F.lit(1)),
                    _classwise(F.substr(canon, F.lit(2)), stream))


def luhn_sum(digits: Column) -> Column:
    """Luhn check sum modulo 10 (0: valid)."""
    n = F.length(digits)
    value = F.transform(_chars(digits), lambda c, i: let(
        c.cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10


def _card(canon: Column, stream: Column) -> Column:
    """New digits with the check sum of the old ones."""
    head = _numbers(F.substr(canon, F.lit(1), F.length(canon) - 1), stream)
    off = luhn_sum(canon) - luhn_sum(F.concat(head, F.lit("0")))
    return F.concat(head, F.pmod(off, F.lit(10)).cast("string"))


def mod97(chars: Column) -> Column:
    """The remainder by 97 of the number that digits and letters (A: 10 to
    Z: 35) spell, as the check digits of an IBAN are defined."""
    def step(acc: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(_chars(chars), F.lit(0), step)


def _iban(canon: Column, stream: Column) -> Column:
    """The country stays; the check digits (02 to 98) leave the remainder of
    the old number, so that valid numbers stay valid and others invalid."""
    country, old = F.substr(canon, F.lit(1), F.lit(2)), F.substr(canon, F.lit(5))

    def checked(new: Column) -> Column:
        off = F.pmod(mod97(F.concat(old, F.substr(canon, F.lit(1), F.lit(4))))
                     - mod97(F.concat(new, country, F.lit("00"))), F.lit(97))
        check = F.when(off < 2, off + 97).otherwise(off)
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), new)
    return let(_classwise(old, stream), checked)


def _named(gender: str | None, canon: Column, stream: Column, attempt: Column) -> Column:
    """A given name of the gender (behind the first attempt with syllables
    more, so that room grows with every attempt), or a family name (None)."""
    def of(script: str) -> Column:
        if gender:
            pool = GIVEN[script, gender]
            first = F.get(F.array(*[F.lit(p) for p in pool]), _byte(stream, F.lit(0)) % len(pool))
            return F.when(attempt == 0, first).otherwise(F.concat(first, syllables(script, attempt + 1)))
        return F.initcap(syllables(script, F.lit(3) + attempt))

    def syllables(script: str, n: Column) -> Column:
        pick = F.array(*[F.lit(p) for p in SYLLABLES[script]])
        return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.get(
            pick, _byte(stream, i) % len(SYLLABLES[script]))), "")
    return F.when(canon.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The surrogate, in canonical form, of the given attempt."""
    def draw(s: Column) -> Column:
        domain = F.regexp_extract(canon, "@(.*)$", 1)
        host = F.substr(F.conv(F.substr(F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("host"), domain), 256),
                                        F.lit(1), F.lit(8)), 16, 10), F.lit(1), F.lit(6))
        email = F.concat(_classwise(F.regexp_extract(canon, "^([^@]*)", 1), s), F.lit("@mail"), host,
                         F.lit(".example.net"))
        octets = [(_byte(s, F.lit(i))).cast("string") for i in range(3)]
        ip = F.concat_ws(".", F.when(attempt < 3, F.lit("10")).otherwise(
            (F.lit(240) + _byte(s, F.lit(3)) % 15).cast("string")), *octets)
        hexes = F.substr(s, F.lit(1), F.length(canon))
        return (F.when(kind == "email", email).when(kind == "ip", ip)
                .when(kind == "card", _card(canon, s)).when(kind.isin("phone", "ssn"), _numbers(canon, s))
                .when(kind == "iban", _iban(canon, s))
                .when(kind == "family", _named(None, canon, s, attempt))
                .when(kind == "given_f", _named("f", canon, s, attempt))
                .when(kind == "given_m", _named("m", canon, s, attempt))
                .when(canon.rlike("^[0-9a-f]+$"), hexes).otherwise(_classwise(canon, s)))
    return let(_stream(key, kind, canon, attempt), draw)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon), all surrogates of
    a kind distinct and none a real entity."""
    spark = entities.sparkSession
    path = scratch_path(spark, "surrogates")
    schema = "kind string, canon string, surrogate string, taken string"
    pending, attempt = entities.select("kind", "canon"), 0
    while True:
        drawn = materialise(pending.withColumn("surrogate", surrogate(
            key, F.col("kind"), F.col("canon"), F.lit(attempt))).withColumn("taken", F.lower("surrogate")), "drawn")
        free = drawn.join(entities.select("kind", F.lower("canon").alias("taken")).distinct(),
                          ["kind", "taken"], "left_anti")
        if attempt:
            free = free.join(spark.read.schema(schema).parquet(path), ["kind", "taken"], "left_anti")
        first = free.groupBy("kind", "taken").agg(F.min("canon").alias("canon"), F.min_by("surrogate", "canon").alias("surrogate"))
        won = materialise(first.select("kind", "canon", "surrogate", "taken"), "won")
        won.write.mode("append").parquet(path)
        pending = materialise(drawn.select("kind", "canon").join(won, ["kind", "canon"], "left_anti"), "pending")
        attempt += 1
        if not pending.take(1):
            return spark.read.schema(schema).parquet(path).drop("taken")


def _dressed(kind: Column, surface: Column, sur: Column) -> Column:
    """The surrogate in the layout and case of the spelling it replaces."""
    def step(acc: Column, c: Column) -> Column:
        slot = F.when(acc["kind"] == "iban", c != " ").otherwise(c.rlike("[0-9]"))
        return F.struct(F.concat(acc["out"], F.when(slot, F.substr(acc["sur"], acc["at"], F.lit(1))).otherwise(c)).alias("out"),
                        (acc["at"] + F.when(slot, 1).otherwise(0)).alias("at"),
                        acc["sur"].alias("sur"), acc["kind"].alias("kind"))
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), sur.alias("sur"), kind.alias("kind"))
    laid = F.aggregate(_chars(surface), start, step, lambda acc: acc["out"])
    upper = (F.length(surface) > 1) & (surface == F.upper(surface))
    return (F.when(kind.isin("phone", "card", "ssn", "iban"), laid)
            .when(kind.isin("email", "given_f", "given_m", "family") & upper, F.upper(sur)).otherwise(sur))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every entity replaced, and ``n_entities``."""
    cols = [c for c in docs.columns if c.lower() != "n_entities"]
    tid, doc, seg, rep = spare(docs.columns, "tid", "doc", "seg", "rep")
    text = F.col(f"`{text_col}`")
    docs = docs.select(*[F.col(f"`{c}`") for c in cols])
    has = F.coalesce(text.rlike(HINT) & text.rlike(MASTER), F.lit(False))
    hit = materialise(docs.where(has).select("*", F.xxhash64(text).alias(tid), F.col(f"`{id_col}`").alias(doc),
                                             parts(text).alias(seg)), "with-entities")
    found = (hit.select(F.col(doc).alias("doc"), F.col(tid).alias("tid"), F.posexplode(seg).alias("pos", "p"))
             .select("doc", "tid", "pos", "p.kind", "p.surface").distinct()
             .withColumn("canon", _canon(F.col("kind"), F.col("surface"))))
    entities = materialise(found.groupBy("kind", "canon").agg(F.count(F.lit(1)).alias("n")), "entities")
    table = materialise(surrogates(entities, key), "surrogate-table")
    placed = (found.join(table, ["kind", "canon"])
              .select("doc", "tid", "pos", _dressed(F.col("kind"), F.col("surface"), F.col("surrogate")).alias("new")))
    lists = (placed.groupBy("doc", "tid").agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias(rep))
             .select(F.col("doc").alias(doc), F.col("tid").alias(tid), rep))
    joined = hit.join(lists, same(hit, lists, doc, tid)).select(
        *[hit[f"`{c}`"] for c in cols], hit[seg], lists[rep])
    tail = F.element_at(F.split(text, MASTER, -1), -1)
    new_text = F.concat(F.array_join(F.zip_with(seg, rep, lambda s, r: F.concat(s["lead"], r["new"])), ""), tail)
    changed = joined.select(*[new_text.alias(c) if c == text_col else F.col(f"`{c}`") for c in cols],
                            F.size(seg).cast("long").alias("n_entities"))
    rest = docs.where(~has).select("*", F.lit(0).cast("long").alias("n_entities"))
    return rest.unionByName(changed)
