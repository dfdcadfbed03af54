"""Replacing personal data by surrogates.

Entities are found by patterns over whole texts. Each distinct entity gets one surrogate, made
from a keyed hash of its canonical form, so that all mentions of it, however written, get the
same one in every document and run. The surrogate keeps what the entity is: digits stay
digits, vowels vowels, a script its letters; a phone keeps its international lead digit, an
address its top-level domain, a card number its validity under the check digit, an IBAN
its country, a name the title before it and its last letter, which carry the gender. Each
mention keeps its own separators and capitals.

Surrogates are checked for collisions: two entities of a kind never share one, and none equals
an entity that occurs. Those that collide are hashed again with the next attempt number, and
from attempt ``SAME_LENGTH`` on with one letter or digit more at each attempt, so that no form is
used up. Only addresses of hosts keep their form always; there are 3.7 billion of them.

Only DataFrame functions are used. Shuffled are mentions and distinct entities, never texts
without personal data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats.llm.common import read_table, small, unused
from logstats.scratch import checkpointed

KEY = "surrogates-1"
SAME_LENGTH = 8

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_TITLE = (
    r"(?:Mr|Mrs|Ms|Miss|Mister|Sir|Madam|Dr|Prof|Herrn?|Frau|Monsieur|Madame|Mme|Mlle|"
    r"Señora?|Sra?|Doña|Don|господин|госпожа)\.?"
)
# In this order: where two kinds could begin, the first is taken.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": (
        r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|"
        r"sk-[A-Za-z0-9_-]{20,})(?![A-Za-z0-9])"
    ),
    "card": (
        r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|"
        r"[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4})(?![0-9A-Za-z])"
    ),
    "phone": (
        r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|"
        r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])"
    ),
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "name": rf"(?<![\p{{L}}]){_TITLE} \p{{Lu}}[\p{{Ll}}]+(?:[ -]\p{{Lu}}[\p{{Ll}}]+){{0,2}}",
}
ANY = "|".join(PATTERNS.values())
# Letters that stand for one another, by script and kind.
LETTERS = (
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "àáâãäåæèéêëìíîïòóôõöøœùúûüýÿąęőű",
    "çćčďđğłńňñřśšşťźžż",
    "аеёиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
)
# Of these kinds, a longer surrogate has its further letters in front; of others, behind.
LONGER_IN_FRONT = ("name", "email", "secret")


def mentions_of(text: Column) -> Column:
    """All entities of a text as they are written, in order."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.array())


def kind_of(mention: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def _without_title(mention: Column) -> Column:
    return F.regexp_replace(mention, rf"^{_TITLE} ", "")


def canonical(kind: Column, mention: Column) -> Column:
    """What mentions of the same entity have in common: digits and letters in lower case."""
    plus = F.when(mention.startswith("+"), "+").otherwise("")
    return (
        F.when(kind.isin("card", "ssn"), F.regexp_replace(mention, "[^0-9]", ""))
        .when(kind == "phone", F.concat(plus, F.regexp_replace(mention, "[^0-9]", "")))
        .when(kind == "iban", F.lower(F.regexp_replace(mention, " ", "")))
        .when(kind == "name", F.lower(_without_title(mention)))
        .when(kind == "secret", mention)
        .otherwise(F.lower(mention))
    )


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _luhn(digits: Column) -> Column:
    """The check sum of an array of digits, modulo 10."""
    backwards = F.reverse(digits)

    def weighed(digit: Column, i: Column) -> Column:
        value = digit.cast("int")
        twice = F.when(value > 4, value * 2 - 9).otherwise(value * 2)
        return F.when(i % 2 == 1, twice).otherwise(value)

    parts = F.transform(backwards, weighed)
    return F.aggregate(parts, F.lit(0), lambda total, part: total + part) % 10


def surrogate(kind: Column, entity: Column, attempt: Column, key: str = KEY) -> Column:
    """The letters and digits that replace those of a canonical form; an address for ``ip``."""
    seed = F.concat_ws("|", F.lit(key), kind, entity, attempt.cast("string"))
    stream = F.concat(F.sha2(F.concat(seed, F.lit("|a")), 512), F.sha2(F.concat(seed, F.lit("|b")), 512))
    own = _chars(F.regexp_replace(entity, r"[^\p{L}0-9]", ""))
    more = F.greatest(attempt - (SAME_LENGTH - 1), F.lit(0))
    in_front = kind.isin(*LONGER_IN_FRONT)
    plain = F.when(in_front, F.concat(F.array_repeat(F.lit("b"), more), own)).otherwise(
        F.concat(own, F.array_repeat(F.lit("0"), more))
    )
    size = F.size(plain)
    kept_front = F.when((kind == "phone") & entity.startswith("+"), 1).when(kind == "iban", 2).otherwise(0)
    kept_back = (
        F.when(kind == "email", F.length(F.substring_index(entity, ".", -1)))
        .when(kind == "name", 1)
        .otherwise(0)
    )

    def replaced(c: Column, i: Column) -> Column:
        byte = _byte(stream, i)
        new = F.when(c.between("0", "9"), (byte % 10).cast("string"))
        new = new.when((kind == "secret") & c.between("a", "f"), F.substring(F.lit("abcdef"), byte % 6 + 1, F.lit(1)))
        for letters in LETTERS:
            picked = F.substring(F.lit(letters), byte % len(letters) + 1, F.lit(1))
            new = new.when(F.position(F.lower(c), F.lit(letters)) > 0, picked)
        return F.when((i < kept_front) | (i >= size - kept_back), c).otherwise(new.otherwise(c))

    changed = F.transform(plain, replaced)
    front = F.slice(changed, 1, size - 1)
    last = F.pmod(_luhn(own) - _luhn(F.concat(front, F.array(F.lit("0")))), F.lit(10)).cast("string")
    card = F.array_join(F.concat(front, F.array(last)), "")
    octets = [_byte(stream, F.lit(i)) for i in range(4)]
    address = F.concat_ws(
        ".", octets[0] % 223 + 1, octets[1], octets[2], octets[3] % 254 + 1
    )
    return F.when(kind == "ip", address).when(kind == "card", card).otherwise(F.array_join(changed, ""))


def _comparable(kind: Column, entity: Column) -> Column:
    """An entity in the form of a surrogate, to tell whether one equals it."""
    return F.when(kind == "ip", entity).otherwise(F.regexp_replace(entity, r"[^\p{L}0-9]", ""))


def assign_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind``, ``entity`` with ``replacement``, distinct within a kind.

    Of entities that collide the one with the fewest attempts, then the smallest, keeps its
    surrogate; whatever equals a real entity is hashed again. Only the others are looked at
    in the next round, against all settled ones.
    """
    open_ones = checkpointed(entities.select("kind", "entity").distinct().withColumn("attempt", F.lit(0)))
    real = checkpointed(
        open_ones.select("kind", _comparable(F.col("kind"), F.col("entity")).alias("replacement"))
    )
    settled = open_ones.select("kind", "entity", F.lit("").alias("replacement")).filter("false")
    while True:
        tried = open_ones.withColumn(
            "replacement", surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), key)
        )
        first = tried.groupBy("kind", "replacement").agg(F.min("entity").alias("_first"))
        taken = real.unionByName(settled.select("kind", "replacement")).distinct()
        free = first.join(taken, ["kind", "replacement"], "left_anti")
        marked = checkpointed(
            tried.join(free, ["kind", "replacement"], "left").withColumn(
                "_won", F.coalesce(F.col("entity") == F.col("_first"), F.lit(False))
            )
        )
        settled = settled.unionByName(marked.filter("_won").select("kind", "entity", "replacement"))
        open_ones = marked.filter("NOT _won").select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        if open_ones.isEmpty():
            return settled


def fitted(kind: Column, mention: Column, replacement: Column) -> Column:
    """A surrogate written the way a mention is: its title, separators and capitals."""
    title = F.when(kind == "name", F.regexp_extract(mention, rf"^{_TITLE} ", 0)).otherwise("")
    body = F.when(kind == "name", _without_title(mention)).otherwise(mention)
    more = F.length(replacement) - F.length(F.regexp_replace(body, r"[^\p{L}0-9]", ""))
    in_front = F.when(kind.isin(*LONGER_IN_FRONT), more).otherwise(0)
    start = F.struct(F.lit("").alias("text"), in_front.alias("used"))

    def step(state: Column, c: Column) -> Column:
        letter = F.substring(replacement, state["used"] + 1, F.lit(1))
        letter = F.when(c.rlike(r"\p{Lu}"), F.upper(letter)).otherwise(letter)
        fits = c.rlike(r"[\p{L}0-9]")
        return F.struct(
            F.concat(state["text"], F.when(fits, letter).otherwise(c)).alias("text"),
            (state["used"] + F.when(fits, 1).otherwise(0)).alias("used"),
        )

    rebuilt = F.aggregate(_chars(body), start, step)["text"]
    front = F.substring(replacement, F.lit(1), in_front)
    capital = F.substring(body, 1, 1).rlike(r"\p{Lu}")
    longer = F.when(capital, F.concat(F.initcap(front), F.lower(F.substring(rebuilt, 1, 1)))).otherwise(
        F.concat(front, F.substring(rebuilt, 1, 1))
    )
    behind = F.substr(replacement, F.length(replacement) - more + 1)
    rebuilt = (
        F.when(in_front > 0, F.concat(longer, F.substr(rebuilt, F.lit(2))))
        .when(more > 0, F.concat(rebuilt, behind))
        .otherwise(rebuilt)
    )
    return F.when(kind == "ip", replacement).otherwise(F.concat(title, rebuilt))


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_replaced``, how many mentions there were.

    Null, empty and clean texts stay as they are, with 0. Equal texts get equal results. An
    empty table stays empty.
    """
    row, found, of = (unused(name, docs) for name in ("_row", "_replacements", "_of"))
    rows = docs.drop("n_replaced").withColumn(row, F.sha1("text"))
    spotted = rows.select(F.col(row).alias("row"), mentions_of(F.col("text")).alias("mentions"))
    mentions = checkpointed(
        spotted.filter(F.size("mentions") > 0)
        .dropDuplicates(["row"])
        .select("row", F.posexplode("mentions").alias("at", "mention"))
        .withColumn("kind", kind_of(F.col("mention")))
        .withColumn("entity", canonical(F.col("kind"), F.col("mention")))
    )
    pairs = assign_surrogates(mentions, key)
    written = mentions.join(pairs, ["kind", "entity"]).select(
        "row", "at", fitted(F.col("kind"), F.col("mention"), F.col("replacement")).alias("new")
    )
    ordered = F.sort_array(F.collect_list(F.struct("at", "new")))
    by_row = written.groupBy("row").agg(F.transform(ordered, lambda m: m["new"]).alias(found))
    by_row = small(by_row.withColumnRenamed("row", of))
    joined = rows.join(by_row, F.col(row) == F.col(of), "left")
    pieces = F.split("text", ANY, -1)
    woven = F.zip_with(
        pieces, F.concat(found, F.array(F.lit(""))), lambda piece, new: F.concat(piece, new)
    )
    text = F.when(F.col(found).isNull(), F.col("text")).otherwise(F.array_join(woven, ""))
    return joined.withColumns(
        {"text": text, "n_replaced": F.coalesce(F.size(found), F.lit(0))}
    ).drop(row, found, of)


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs).select("doc_id", "text", "n_replaced")
