"""Quality rules as a short-circuit cascade.

Every rule reads a few text metrics and says whether a document is to be
rejected. On a bounded sample the cost of each metric is measured (the time of
a pass that works it out, less that of a pass that only reads) and the
selectivity of each rule counted (the share it rejects). Rules then run in the
order of rejection per cost. They are nested branches of one expression: a metric
is worked out once, where the first rule that needs it is reached, so only for the
documents that the earlier rules let through. The order never changes which
documents are kept, only the work done and the rule that is named; as times vary,
so may the order of rules of about equal worth.

Defined cases: null and empty texts have no words and fail the word-count
rule; duplicate rows are judged one by one; an empty table gives an empty
result (and the declared order of rules); extra columns of the input are
carried by ``filter_documents`` and ignored by ``judge_documents``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import BLANKS, blank_words, let, n_blank_words
from .tables import stored

REPEAT_WINDOW = 8
SAMPLE_ROWS = 2000


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return F.length(F.regexp_replace(_text(text), BLANKS + "+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(_text(text), F.lit(r"[#*$%&|<>]")).cast("long")


def n_exclamations(text: Column) -> Column:
    return F.regexp_count(_text(text), F.lit("!")).cast("long")


def n_capitals(text: Column) -> Column:
    return F.regexp_count(_text(text), F.lit("[A-Z]")).cast("long")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(_text(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_lines(text: Column) -> Column:
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column, k: int = REPEAT_WINDOW) -> Column:
    """Words inside ``k``-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash of their words' hashes. Only texts
    with a repeated window sort their windows: equal hashes become neighbours,
    their positions are put in order again, and each position adds the words
    up to the next one, ``k`` at most.
    """
    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (k - 1)),
                           lambda i: F.xxhash64(F.slice(hashes, i, k)))

    def repeated_positions(ordered: Column) -> Column:
        twins = F.filter(ordered, lambda x, i:
                         F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(twins, lambda x: x["p"]))

    def covered(positions: Column) -> Column:
        steps = F.transform(positions, lambda x, i: F.least(
            F.lit(k), F.coalesce(F.get(positions, i + 1) - x, F.lit(k))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def of_windows(w: Column) -> Column:
        ordered = F.sort_array(F.transform(
            w, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        heavy = let(let(ordered, repeated_positions), covered)
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(heavy)

    hashes = F.transform(blank_words(text), lambda x: F.xxhash64(x))
    return let(hashes, lambda h: F.when(F.size(h) <= k, F.lit(0))
               .otherwise(let(windows(h), of_windows))).cast("long")


#: Metric name -> expression over the text.
METRICS: dict[str, Callable[[Column], Column]] = {
    "n_words": n_blank_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_exclamations": n_exclamations,
    "n_capitals": n_capitals,
    "n_lines": n_lines,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
}

#: Metrics that the result holds; the others are worked out inside the cascade.
BASE_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

Metric = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``reject`` holds; ``uses`` names its metrics."""

    name: str
    uses: tuple[str, ...]
    reject: Callable[[Metric], Column]


BASE_RULES = (
    Rule("too_few_words", ("n_words",), lambda m: m("n_words") < 20),
    Rule("repeated_windows", ("n_repeat_words", "n_words"),
         lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
)

#: Rules of the method beside the base; bounds leave room above what prose shows.
RULES = (
    Rule("symbols", ("n_symbols", "n_words"), lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule("exclamations", ("n_exclamations", "n_words"),
         lambda m: 10 * m("n_exclamations") > 3 * m("n_words")),
    Rule("capitals", ("n_capitals", "word_chars"),
         lambda m: 10 * m("n_capitals") > 4 * m("word_chars")),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"),
         lambda m: 10 * m("n_dup_lines") > 4 * m("n_lines")),
    Rule("word_length", ("word_chars", "n_words"),
         lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words"))),
)


def _seconds(frame: DataFrame, of: Column, passes: int = 2) -> float:
    """Time of a pass that works out a column, the best of ``passes``."""
    best = float("inf")
    for _ in range(passes):
        began = time.perf_counter()
        frame.agg(F.sum(of)).collect()
        best = min(best, time.perf_counter() - began)
    return best


def estimate_rules(documents: DataFrame, rules: Sequence[Rule], text: str = "text",
                   key: str = "doc_id", sample_rows: int = SAMPLE_ROWS,
                   ready: Sequence[str] = ()) -> dict[str, tuple]:
    """(seconds of its metrics, share rejected) of each rule on the
    ``sample_rows`` documents with the smallest key hash (as many again where
    keys repeat). Metrics that are ``ready`` as columns cost nothing."""
    place = F.xxhash64(F.col(key))
    bound = (documents.select(place.alias("place")).orderBy("place").limit(sample_rows)
             .agg(F.max("place")).scalar())
    sample = stored(documents.where(place <= bound).select(F.col(text).alias("t"))
                    .limit(2 * sample_rows), "quality-sample")
    names = list(dict.fromkeys(x for r in rules for x in r.uses))
    measured = sample.select(*[METRICS[x](F.col("t")).alias(f"m_{x}") for x in names])
    row = measured.agg(*[F.avg(r.reject(lambda x: F.col(f"m_{x}")).cast("double")).alias(f"r_{i}")
                         for i, r in enumerate(rules)]).first()
    read = _seconds(sample, F.octet_length("t"))
    cost = {x: max(_seconds(sample, METRICS[x](F.col("t"))) - read, 0.0)
            for x in names if x not in ready}
    return {r.name: (1e-4 + sum(cost.get(x, 0.0) for x in r.uses), row[f"r_{i}"] or 0.0)
            for i, r in enumerate(rules)}


def order_rules(rules: Sequence[Rule], estimates: Mapping[str, tuple]) -> list[Rule]:
    """Most rejection per cost first; ties by cost, then by declaration."""
    def rank(r: Rule):
        cost, rejected = estimates[r.name]
        return (-rejected / cost, cost)
    return sorted(rules, key=rank)


def first_failure(rules: Sequence[Rule], text: Column, known: Mapping[str, Column]) -> Column:
    """Name of the first rule that rejects; null when all let it through. A
    metric that is not in ``known`` is worked out where a rule first needs it
    and handed to the rules after it."""
    if not rules:
        return F.lit(None).cast("string")
    rule, missing = rules[0], [x for x in rules[0].uses if x not in known]

    def judged(all_known: Mapping[str, Column]) -> Column:
        return F.when(rule.reject(all_known.__getitem__), F.lit(rule.name)).otherwise(
            first_failure(rules[1:], text, all_known))
    if not missing:
        return judged(known)
    made = F.struct(*[METRICS[x](text).alias(x) for x in missing])
    return let(made, lambda m: judged({**known, **{x: m[x] for x in missing}}))


def judge_documents(documents: DataFrame, text: str = "text", key: str = "doc_id",
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base metrics, base verdict, verdict and failing rule of every document.
    The other metrics are worked out inside the cascade, so only for what the
    base rules and the rules before theirs leave undecided."""
    estimates = estimate_rules(documents, RULES, text, key, sample_rows, BASE_METRICS)
    t = F.col("t")
    ready = {n: F.col(n) for n in BASE_METRICS}
    measured = (documents.select(F.col(key).alias("doc_id"), F.col(text).alias("t"))
                .select("doc_id", "t", *[METRICS[n](t).alias(n) for n in BASE_METRICS]))
    base = first_failure(BASE_RULES, t, ready)
    return (measured
            .withColumn("base_failed", base.isNotNull())
            .withColumn("failed_rule", first_failure(
                (*BASE_RULES, *order_rules(RULES, estimates)), t, ready))
            .withColumn("kept", F.col("failed_rule").isNull()).drop("t"))


def filter_documents(documents: DataFrame, text: str = "text", key: str = "doc_id",
                     sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents that no rule rejects, with their columns."""
    rules = (*BASE_RULES, *RULES)
    ordered = order_rules(rules, estimate_rules(documents, rules, text, key, sample_rows))
    return documents.where(first_failure(ordered, F.col(text), {}).isNull())
