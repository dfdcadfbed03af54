"""Filtering URLs by rules, and by the ratio of two character language models.

URLs that a rule decides are the examples: allowed ones train one model, blocked ones the
other. A model predicts each character from up to ``ORDER`` characters before it. The order
varies: a context that was not seen hands over to the next shorter one, and each order is smoothed with the shorter one by how many different
characters followed it (Witten-Bell). A URL's score is the difference of its log-likelihoods
under both models for each character, and the threshold is calibrated on examples kept
out of the counts.

Counting is a Spark aggregation over all examples, and every gram that occurs is kept, in a
table. Characters are mapped to ``ALPHABET``, so an order has at most
2 * (len(ALPHABET) + 2) ** (order + 1) entries. The distinct grams of the URLs meet that table
by joins, once for each order, and a URL's score is summed up from its grams; the driver gets
only the bins of the threshold.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats.llm.common import LOWER, UPPER, ascii_lower, read_table, small, unused
from logstats.scratch import checkpointed

# The rules, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
ORDER = 4
# Digits are mapped to 0 and characters that are not listed to *.
ALPHABET = LOWER + "0./-_?=&%#:~+@*"
START, END = "^", "$"
# Scores are counted in bins of this width for the threshold, up to the largest score.
BIN, LARGEST = 0.01, 30.0
HELD_OUT = 5
KINDS = ("allow", "block")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(
    host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES
) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, name, start in sorted(rules, key=lambda rule: len(rule[1] + rule[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text = F.when(fits, name + start).otherwise(text)
        verdict = F.when(fits, decision).otherwise(verdict)
    return text, verdict


def model_text(url: Column) -> Column:
    """A URL without its scheme, in the model's alphabet, with marks at both ends."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[^/?#]*://", "")
    plain = F.translate(rest, UPPER + "123456789", LOWER + "000000000")
    listed = "".join("\\" + c if not c.isalnum() else c for c in ALPHABET)
    plain = F.regexp_replace(plain, f"[^{listed}]", "*")
    return F.concat(F.lit(START * ORDER), plain, F.lit(END))


def grams_of(chars: str) -> Column:
    """All longest grams of a model text, one for each character and the end."""
    places = F.sequence(F.lit(1), F.length(chars) - ORDER)
    return F.transform(places, lambda i: F.col(chars).substr(i, F.lit(ORDER + 1)))


def count_grams(examples: DataFrame) -> DataFrame:
    """``gram`` with its numbers ``allow`` and ``block`` from examples with ``verdict`` and ``chars``.

    Only the longest grams are counted from the text; the shorter ones are their ends.
    """
    found = examples.select("verdict", F.explode(grams_of("chars")).alias("gram"))
    return checkpointed(
        found.groupBy("gram").agg(
            *(F.count(F.when(F.col("verdict") == kind, 1)).alias(kind) for kind in KINDS)
        )
    )


def gram_ratios(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """Distinct ``gram`` with ``ratio``, the log-likelihood ratio of its last character.

    Each order is joined to the ends of the grams, the shortest first. At most as many ends as
    there are characters share a context, and so no key is frequent.
    """
    uniform = F.lit(1.0 / (len(ALPHABET) + 1))
    shorter = None
    for length in range(1, ORDER + 2):
        level = counts.groupBy(F.expr(f"right(gram, {length})").alias("gram")).agg(
            *(F.sum(kind).alias(kind) for kind in KINDS)
        )
        contexts = level.groupBy(F.expr(f"left(gram, {length - 1})").alias("_context")).agg(
            *(F.sum(kind).alias(f"{kind}_total") for kind in KINDS),
            *(F.count(F.when(F.col(kind) > 0, 1)).alias(f"{kind}_kinds") for kind in KINDS),
        )
        ends = grams.select(F.expr(f"right(gram, {length})").alias("gram")).distinct()
        ends = ends.withColumns(
            {"_context": F.expr(f"left(gram, {length - 1})"), "_end": F.expr(f"right(gram, {length - 1})")}
        )
        met = ends.join(level, "gram", "left").join(contexts, "_context", "left")
        if shorter is None:
            met = met.withColumns({f"{kind}_p": uniform for kind in KINDS})
        else:
            met = met.join(shorter.withColumnRenamed("gram", "_end"), "_end")
        smoothed = []
        for kind in KINDS:
            n, total, kinds, p = (F.col(kind + end) for end in ("", "_total", "_kinds", "_p"))
            seen = (F.coalesce(n, F.lit(0)) + kinds * p) / (total + kinds)
            smoothed.append(F.when(total > 0, seen).otherwise(p).alias(f"{kind}_p"))
        shorter = checkpointed(met.select("gram", *smoothed))
    allow, block = (F.col(f"{kind}_p") for kind in KINDS)
    return shorter.select("gram", (F.log(allow) - F.log(block)).alias("ratio"))


def text_scores(counts: DataFrame, texts: DataFrame) -> DataFrame:
    """Distinct ``chars`` of ``texts`` with ``score``, the mean ratio of their characters.

    Ratios are summed up as decimals, so that the order of the sum does not matter.
    """
    texts = checkpointed(
        checkpointed(texts.select("chars").distinct()).withColumn("_text", F.monotonically_increasing_id())
    )
    places = texts.select("_text", F.explode(grams_of("chars")).alias("gram"))
    ratios = gram_ratios(counts, checkpointed(places.select("gram").distinct()))
    ratios = small(ratios.withColumn("ratio", F.col("ratio").cast("decimal(22,18)")))
    sums = places.join(ratios, "gram").groupBy("_text").agg(F.sum("ratio").alias("_sum"))
    mean = F.col("_sum").cast("double") / (F.length("chars") - ORDER)
    return checkpointed(texts.join(sums, "_text").select("chars", mean.alias("score")))


class GramModel:
    """Log-likelihood ratio of a character after its context, from gram counts.

    This states on single grams what ``gram_ratios`` computes on tables, for tests.
    """

    def __init__(self, grams: Iterable[tuple[str, str, int]]):
        self.counts = {"allow": {}, "block": {}}
        self.contexts = {"allow": defaultdict(lambda: (0, 0)), "block": defaultdict(lambda: (0, 0))}
        for verdict, gram, n in grams:
            self.counts[verdict][gram] = n
            total, kinds = self.contexts[verdict][gram[:-1]]
            self.contexts[verdict][gram[:-1]] = (total + n, kinds + 1)
        for verdict in self.contexts:
            self.contexts[verdict] = dict(self.contexts[verdict])
        self.known: dict[str, float] = {}

    @property
    def trained(self) -> bool:
        return bool(self.counts["allow"]) and bool(self.counts["block"])

    def probability(self, verdict: str, gram: str) -> float:
        counts, contexts = self.counts[verdict], self.contexts[verdict]
        p = 1.0 / (len(ALPHABET) + 1)
        for order in range(len(gram)):
            end = gram[len(gram) - 1 - order :]
            if end[:-1] not in contexts:
                break
            total, kinds = contexts[end[:-1]]
            p = (counts.get(end, 0) + kinds * p) / (total + kinds)
        return p

    def ratio(self, gram: str) -> float:
        if gram not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            allow, block = self.probability("allow", gram), self.probability("block", gram)
            self.known[gram] = math.log(allow) - math.log(block)
        return self.known[gram]

    def score(self, chars: str) -> float:
        places = range(len(chars) - ORDER)
        return sum(self.ratio(chars[i : i + ORDER + 1]) for i in places) / len(places)


def calibrated_threshold(scores: DataFrame) -> float:
    """The score that best separates ``verdict`` allow from block among held-out examples.

    Scores are counted in bins of fixed width, so the driver gets a bounded table. Best is
    the largest mean of both hit rates; of equally good limits the one nearest to 0. It is 0
    if an example kind is missing.
    """
    bound = F.greatest(F.least("score", F.lit(LARGEST)), F.lit(-LARGEST))
    bins = scores.groupBy("verdict", F.floor(bound / BIN).alias("bin")).count().collect()
    by_kind = {"allow": defaultdict(int), "block": defaultdict(int)}
    for row in bins:
        by_kind[row["verdict"]][row["bin"]] += row["count"]
    totals = {kind: sum(counts.values()) for kind, counts in by_kind.items()}
    if not all(totals.values()):
        return 0.0
    limits = sorted(set(by_kind["allow"]) | set(by_kind["block"]) | {0})
    limits.append(limits[-1] + 1)

    def quality(limit: int) -> tuple[float, int]:
        allowed = sum(n for at, n in by_kind["allow"].items() if at >= limit)
        blocked = sum(n for at, n in by_kind["block"].items() if at < limit)
        return allowed / totals["allow"] + blocked / totals["block"], -abs(limit)

    return max(limits, key=quality) * BIN


def filter_urls(
    rows: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """Every row with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    The verdict is that of the longest rule that fits, else allow for a score at or above
    the threshold. Null and malformed URLs have no host and no path and are scored by
    their text. Without examples of both kinds there is no evidence and the verdict is
    allow, with a null score. Equal URLs are judged alike; an empty table stays empty.
    """
    rows = rows.drop("host", "path", "rule", "verdict", "score")
    chars, raw, ruled = (unused(name, rows) for name in ("_chars", "_url", "_ruled"))
    parsed = rows.withColumn(raw, F.col(url))
    host, path = url_parts(F.col(raw))
    parsed = parsed.withColumns({"host": host, "path": path, chars: model_text(F.col(raw))})
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.withColumns({"rule": rule, ruled: verdict}).drop(raw)
    examples = judged.filter(F.col(ruled).isNotNull()).select(
        F.col(ruled).alias("verdict"),
        F.col(chars).alias("chars"),
        (F.pmod(F.xxhash64(chars), F.lit(HELD_OUT)) == 0).alias("held_out"),
    )
    counts = count_grams(examples.filter("NOT held_out"))
    trained = [kind for kind in KINDS if not counts.filter(F.col(kind) > 0).isEmpty()]
    if len(trained) < len(KINDS):
        filled = {"verdict": F.coalesce(ruled, F.lit("allow")), "score": F.lit(None).cast("double")}
        return judged.withColumns(filled).drop(chars, ruled)
    scores = small(text_scores(counts, judged.select(F.col(chars).alias("chars"))))
    held_out = examples.filter("held_out").join(scores, "chars")
    threshold = calibrated_threshold(held_out)
    by_score = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return (
        judged.join(scores.withColumnRenamed("chars", chars), chars)
        .withColumn("verdict", F.coalesce(ruled, by_score))
        .drop(chars, ruled)
    )


def op7_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = filter_urls(pages)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")
