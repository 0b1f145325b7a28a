"""URL filter from association rules.

Labelled pages become transactions of their url's tokens and one class item;
Spark's FP-growth mines the frequent combinations and its association rules
``tokens => class`` are pruned by support and confidence, and by each other (a
longer combination must be surer than every part of it that is a rule, which is
looked up among the rules). All pages are then matched through an inverted
index: each rule is filed under its tokens, url tokens meet the index in a join,
and a rule holds when as many of its tokens were met as it has. The surest rule
that holds decides.

A token counts from ``MIN_BASKETS`` labelled urls on, however few labels there
are. Tokens that stand in exactly the same labelled urls are one item, and any of
them stands for it afterwards: their combinations say nothing more.

FP-growth lists every subset of what many urls share. Where a labelled url has
more than ``MAX_TOKENS`` items, the same rules are mined level by level instead:
a combination grows only while its urls are of both classes, enough of them, and
fewer than those of each of its parts. No other combination can be surer than
all its parts, so nothing that the pruning keeps is missed.

Hand-written rules (host and path prefix, allow or block) come first; the
longest that fits decides.

Defined cases: a null url, or one without ``://``, has an empty host, an
empty path and no tokens, so it gets the default verdict; long urls are taken
whole; pages of equal urls share one match; without labelled pages no rules
are mined and every page gets the default; an empty table gives an empty
result; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import union_all
from .columns import LOWER, UPPER
from .tables import join_small, stored

BLOCK, ALLOW = "block", "allow"
CLASS_BLOCK, CLASS_ALLOW = "#block", "#allow"
#: Labelled urls that a rule rests on at least, and items of a labelled url up to
#: which FP-growth lists all combinations.
MIN_BASKETS, MAX_TOKENS = 5, 10


@dataclass(frozen=True)
class PathRule:
    """``text`` is host and path prefix, like ``example.org/es/``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


# The hand-written rules of the registered query.
PATH_RULES = (
    PathRule(ALLOW, "org/"),
    PathRule(BLOCK, "example.org/es/"),
    PathRule(BLOCK, "example.org/en/1"),
    PathRule(ALLOW, "com/fr/"),
    PathRule(BLOCK, "com/de/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty when it is null or has no ``://``."""
    at = F.instr(url, "://")
    tail = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(tail, r"^([^/?#]*)", 1)
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")),
            F.coalesce(path, F.lit("")))


def longest_rule(host: Column, path: Column, rules: Sequence[PathRule]) -> Column:
    """struct(text, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda x: (len(x.text), x.text)):
        fits = (((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"),
                                    F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column) -> Column:
    """Distinct tokens: ``h:`` host labels, ``p:`` path words, ``q:`` query keys."""
    host, path = url_parts(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)

    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    keys = F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0])
    return F.array_distinct(F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(
        tagged("h:", F.split(host, r"\.")), tagged("p:", F.split(path, r"[/.]+")),
        tagged("q:", keys))))


def _items(baskets: DataFrame, least: int) -> DataFrame:
    """(token, item) of tokens in at least ``least`` baskets: the item a token
    belongs to."""
    sums = baskets.select("k", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("k")).alias("x"), F.sum(F.pmod(F.xxhash64("k", F.lit(1)), F.lit(1 << 40)))
        .alias("s")).where(F.col("n") >= least)
    first = sums.groupBy("n", "x", "s").agg(F.min("token").alias("item"))
    return stored(sums.join(first, ["n", "x", "s"]).select("token", "item"), "url-items")


def _grown_rules(chosen: DataFrame, n: int, least: int, min_confidence: float) -> DataFrame:
    """(tokens, verdict, confidence, support), pruned, of baskets of any length
    (``basket, bad, xs``), level by level: combinations of one more item meet
    in the baskets that hold both, and only open ones grow (see the module)."""
    held = stored(chosen.select("basket", "bad", F.explode("xs").alias("x")).select(
        "basket", "bad", F.array("x").alias("tokens")), "url-held")
    good = F.col("n") - F.col("n_bad")
    sure = {BLOCK: F.col("n_bad") / F.col("n"), ALLOW: good / F.col("n")}
    right = {BLOCK: F.col("n_bad"), ALLOW: good}

    def surest(verdict: str) -> Column:
        is_rule = (right[verdict] >= least) & (sure[verdict] >= min_confidence)
        return F.greatest(F.col(f"part_{verdict}"), F.when(is_rule, sure[verdict]).otherwise(0.0))

    rules, before, size = [], None, 1
    while True:
        counts = held.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum(F.col("bad").cast("long")).alias("n_bad")).where(
            F.greatest("n_bad", good) >= least)
        if before is None:
            counts = counts.select("*", F.lit(0.0).alias(f"part_{BLOCK}"), F.lit(0.0).alias(f"part_{ALLOW}"))
        else:
            # all parts of one item less are open and hold in more baskets
            part = F.expr("transform(tokens, (t, at) -> filter(tokens, (u, i) -> i != at))")
            counts = (counts.select("*", F.explode(part).alias("part")).join(before, "part")
                      .groupBy("tokens", "n", "n_bad")
                      .agg(F.count(F.lit(1)).alias("parts"), F.min("part_n").alias("part_n"),
                           *[F.max(f"part_{v}").alias(f"part_{v}") for v in (BLOCK, ALLOW)])
                      .where((F.col("parts") == size) & (F.col("part_n") > F.col("n")))
                      .drop("parts", "part_n"))
        counts = stored(counts, "url-level")
        rules += [counts.where((right[v] >= least) & (sure[v] >= min_confidence)
                               & (sure[v] > F.col(f"part_{v}")))
                  .select("tokens", F.lit(v).alias("verdict"), sure[v].alias("confidence"),
                          (right[v] / F.lit(n)).alias("support")) for v in (BLOCK, ALLOW)]
        still = counts.where((F.col("n_bad") > 0) & (good > 0))
        if still.isEmpty():
            return stored(union_all(rules), "url-grown")
        before = still.select(F.col("tokens").alias("part"), F.col("n").alias("part_n"),
                              *[surest(v).alias(f"part_{v}") for v in (BLOCK, ALLOW)])
        ends = join_small(held, still.select("tokens"), ["tokens"], "basket").select(
            "basket", "bad", F.expr("slice(tokens, 1, size(tokens) - 1)").alias("head"),
            F.element_at("tokens", -1).alias("tail"))
        others = ends.select("basket", "head", F.col("tail").alias("later"))
        held = stored(ends.join(others, ["basket", "head"]).where("tail < later").select(
            "basket", "bad", F.concat("head", F.array("tail", "later")).alias("tokens")), "url-held")
        size += 1


def mine_rules(pages: DataFrame, labels: DataFrame, url: str, bad: Column,
               page_key: str = "page_id", label_key: str = "doc_id",
               min_support: float = 0.002, min_confidence: float = 0.5,
               min_baskets: int = MIN_BASKETS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(rule, tokens, alternatives, verdict, confidence, support), pruned.
    ``alternatives`` holds, for each token, all tokens that stand for it.

    ``bad`` is a condition on the labels. All labelled pages are mined; a rule
    rests on ``min_support`` of them and on ``min_baskets`` at least. FP-growth
    gets urls of up to ``max_tokens`` items; with longer ones the same rules are
    grown level by level.
    """
    spark = pages.sparkSession
    schema = ("rule bigint, tokens array<string>, alternatives array<array<string>>, verdict string, "
              "confidence double, support double")
    known = labels.select(F.col(label_key).alias("k"), bad.alias("bad")).where(
        F.col("bad").isNotNull()).groupBy("k").agg(F.max("bad").alias("bad"))
    baskets = stored(
        pages.select(F.col(page_key).alias("k"), url_tokens(F.col(url)).alias("tokens"))
        .join(known, "k"), "url-baskets")
    n = baskets.count()
    if n < min_baskets:
        return spark.createDataFrame([], schema)
    least = max(min_baskets, math.ceil(min_support * n))
    items = _items(baskets, least)
    # by place, so that a page that is labelled twice is two baskets
    placed = stored(baskets.select(F.monotonically_increasing_id().alias("basket"), "bad", "tokens"),
                    "url-placed")
    met = join_small(placed.select("basket", F.explode("tokens").alias("token")), items, ["token"],
                     "basket").select("basket", F.col("item").alias("x"))
    chosen = met.groupBy("basket").agg(F.sort_array(F.collect_set("x")).alias("xs"))
    chosen = stored(placed.join(chosen, "basket", "left").select(
        "basket", "bad", F.coalesce("xs", F.array().cast("array<string>")).alias("xs")), "url-chosen")
    if chosen.where(F.size("xs") > max_tokens).isEmpty():
        kept = _listed_rules(chosen, n, least, min_confidence)
    else:
        kept = _grown_rules(chosen, n, least, min_confidence).withColumn("rule", F.xxhash64("tokens", "verdict"))
    stand = items.groupBy("item").agg(F.sort_array(F.collect_list("token")).alias("stands"))
    spelled = (kept.select("rule", F.posexplode("tokens").alias("at", "item")).join(stand, "item")
               .groupBy("rule").agg(F.sort_array(F.collect_list(F.struct("at", "stands"))).alias("all")))
    return stored(kept.join(spelled, "rule").select(
        "rule", "tokens", F.col("all.stands").alias("alternatives"), "verdict", "confidence", "support"),
        "url-rules")


def _listed_rules(chosen: DataFrame, n: int, least: int, min_confidence: float) -> DataFrame:
    """(rule, tokens, verdict, confidence, support), pruned, from FP-growth."""
    verdict = F.when(F.col("bad"), F.lit(CLASS_BLOCK)).otherwise(F.lit(CLASS_ALLOW))
    transactions = stored(chosen.select(F.concat("xs", F.array(verdict)).alias("items")), "url-transactions")
    # half a basket less, so that rounding asks for no more than ``least``
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(
        transactions)
    mined = (model.associationRules
             .where(F.col("consequent")[0].isin(CLASS_BLOCK, CLASS_ALLOW))
             .select(F.sort_array("antecedent").alias("tokens"),
                     F.when(F.col("consequent")[0] == CLASS_BLOCK, BLOCK).otherwise(ALLOW)
                     .alias("verdict"), "confidence", "support"))
    mined = stored(mined.withColumn("rule", F.xxhash64("tokens", "verdict")), "url-mined")
    # A rule goes when a part of it is a rule of the same verdict and as sure:
    # its parts are looked up.
    subsets = F.expr("transform(sequence(1, shiftleft(1, size(tokens)) - 2), "
                     "m -> filter(tokens, (t, i) -> (shiftright(m, i) & 1) = 1))")
    parts = mined.where(F.size("tokens") > 1).select("rule", "verdict", "confidence",
                                                     F.explode(subsets).alias("part"))
    beaten = (parts.join(mined.select(F.col("tokens").alias("part"), "verdict",
                                      F.col("confidence").alias("part_confidence")), ["part", "verdict"])
              .where(F.col("part_confidence") >= F.col("confidence")).select("rule").distinct())
    return mined.join(beaten, "rule", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, verdict, confidence, tokens) of the surest rule of each distinct
    url that some rule matches, through the inverted index."""
    index = rules.select("rule", F.size("tokens").alias("need"),
                         F.posexplode("alternatives").alias("at", "stands")).select(
        F.explode("stands").alias("token"), "rule", "at", "need")
    n = index.count()
    tokens = urls.select(F.col(url).alias("url")).distinct().select(
        "url", F.explode(url_tokens(F.col("url"))).alias("token"))
    met = join_small(tokens, index, ["token"], "url", rows=n)
    # a token of an item marks it, others of the item mark it again
    held = met.groupBy("url", "rule").agg(F.expr("bit_or(shiftleft(1L, at))").alias("met"),
                                          F.max("need").alias("need")).where(
        F.expr("met = shiftleft(1L, need) - 1")).select("url", "rule")
    judged = join_small(held, rules, ["rule"], "url", rows=n)
    best = judged.groupBy("url").agg(F.max(F.struct(
        "confidence", "support", F.size("tokens").alias("size"), "rule", "verdict", "tokens"))
        .alias("best"))
    return best.select("url", "best.verdict", "best.confidence", "best.tokens")


def judge_pages(pages: DataFrame, labels: DataFrame, bad: Column,
                path_rules: Sequence[PathRule] = PATH_RULES, key: str = "page_id",
                url: str = "url", default: str = ALLOW, min_support: float = 0.002,
                min_confidence: float = 0.5) -> DataFrame:
    """Host, path, hand-written rule and verdict of every page."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    rules = mine_rules(rows, labels, "url", bad, "page_id", "doc_id", min_support, min_confidence)
    matched = match_rules(rows, rules).select(
        "url", F.col("verdict").alias("mined"), "confidence", "tokens")
    host, path = url_parts(F.col("url"))
    judged = rows.join(matched, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"), "mined", "confidence", "tokens")
    rule = longest_rule(F.col("host"), F.col("path"), path_rules)
    return judged.select("*", rule.alias("fit")).select(
        "page_id", "host", "path", F.col("fit.text").alias("rule"),
        F.coalesce("fit.verdict", "mined", F.lit(default)).alias("verdict"),
        F.array_join("tokens", " ").alias("mined_tokens"),
        F.col("confidence").alias("mined_confidence"))
