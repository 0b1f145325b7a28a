"""Filter interaction audit: what every order of a set of filters removes.

Each document gets one bit per filter that it fails. Documents of a part with
the same bits are one cell (2^filters cells a part at most), and everything
asked about an order of the filters can be read off the cells, so texts are
scanned once, however many orders there are.

Orders are enumerated by a recursive CTE. A row is a part and a prefix of an
order, with the bits applied so far; a level joins the part's mask cells to the
prefixes, extends each by every unused letter and emits the metrics of that
step. Prefixes that open several orders are worked out once (326 of them for
five filters, where the 120 orders have 600 steps).

The last filter is "identical to the text of a smaller id". Texts are compared
by SHA-256 and length. The smallest id of each text is a mergeable minimum, and
a row is looked up by text and id together, so a text held by a third of all
rows is no hot key.

Defined cases: a null text is an empty one (equal to other empty ones), a null
part is the empty part; a row without id has no label, never fails the identity
filter and makes no other row fail it; rows that share id and text are not identical to a
smaller id by each other; labels may repeat or miss ids (a document counts as
labelled when one of its rows says so); texts are read whole; an empty table
gives an empty result; only the named columns are read, so other columns
cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import blank_words, let
from .tables import stored

ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

TextFilter = Callable[[Column, Column, Column], Column]

#: letter -> failure condition on (text, words, distinct words).
TEXT_FILTERS: dict[str, TextFilter] = {
    "A": lambda text, words, distinct: words < 200,
    "B": lambda text, words, distinct: 100 * distinct < 50 * words,
    "C": lambda text, words, distinct:
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
    "D": lambda text, words, distinct: text.rlike("[#$%&*|]"),
}
IDENTICAL = "E"


def failed_bits(text: Column, filters: Mapping[str, TextFilter]) -> Column:
    """Bits of the filters that a text fails, the first filter lowest."""
    def bits(n: Column) -> Column:
        out = F.lit(0)
        for i, fails in enumerate(filters.values()):
            out = out + F.when(fails(text, n["words"], n["distinct"]), F.lit(1 << i)).otherwise(0)
        return out

    def counted(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("words"),
                        F.size(F.array_distinct(words)).cast("long").alias("distinct"))

    return let(let(blank_words(text), counted), bits).cast("int")


def mask_cells(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
               part: str = "lang", filters: Mapping[str, TextFilter] | None = None) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail,
    stored. The identity filter has the highest bit."""
    filters = TEXT_FILTERS if filters is None else filters
    rows = documents.select(F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                            F.coalesce(F.col(text), F.lit("")).alias("text"))
    facts = stored(rows.select("id", "part", failed_bits(F.col("text"), filters).alias("bits"),
                               F.unhex(F.sha2("text", 256)).alias("digest"),
                               F.octet_length("text").alias("size")), "audit-facts")
    first = (facts.where(F.col("id").isNotNull()).groupBy("digest", "size")
             .agg(F.min("id").alias("id")).withColumn("first", F.lit(True)))
    marked = labels.groupBy(F.col(key).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    again = F.col("id").isNotNull() & F.col("first").isNull()
    return stored(
        facts.join(first, ["digest", "size", "id"], "left").join(marked, "id", "left")
        .select("part", (F.col("bits") + F.when(again, F.lit(1 << len(filters))).otherwise(0))
                .alias("mask"), "good", "toxic")
        .groupBy("part", "mask").agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")), "audit-cells")


# Sums over the cells of a part, by what a step asks of their bits.
_SUM = "aggregate(filter(c.cells, x -> {0}), 0L, (s, x) -> s + x.{1})"
_PASSED = "(x.mask & s.applied) = 0"
_FAILS = "(x.mask & shiftleft(1, s.i)) != 0"
_STEPS = f"""
WITH RECURSIVE steps(part, prefix, applied, step, letter, kept, removed, redundant,
                     unique_fails, good_lost, toxic_lost) AS (
  SELECT part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
  UNION ALL
  SELECT s.part, concat(s.prefix, substr('{{letters}}', s.i + 1, 1)),
         s.applied | shiftleft(1, s.i), s.step + 1, substr('{{letters}}', s.i + 1, 1),
         {_SUM.format(f"{_PASSED} AND NOT {_FAILS}", "n")},
         {_SUM.format(f"{_PASSED} AND {_FAILS}", "n")},
         {_SUM.format(f"NOT {_PASSED} AND {_FAILS}", "n")},
         {_SUM.format("x.mask = shiftleft(1, s.i)", "n")},
         {_SUM.format(f"{_PASSED} AND {_FAILS}", "good")},
         {_SUM.format(f"{_PASSED} AND {_FAILS}", "toxic")}
  FROM (SELECT part, prefix, applied, step, explode(
          filter(sequence(0, {{last}}), i -> (applied & shiftleft(1, i)) = 0)) AS i FROM steps) s
  JOIN {{cells}} c ON c.part = s.part)
SELECT * FROM steps WHERE step > 0
"""


def prefix_steps(cells: DataFrame, letters: str) -> DataFrame:
    """Metrics of the last step of every prefix of every order, stored."""
    spark = cells.sparkSession
    by_part = stored(cells.groupBy("part").agg(F.sort_array(F.collect_list(
        F.struct("mask", "n", "good", "toxic"))).alias("cells")), "audit-parts")
    rows = by_part.count() * sum(math.perm(len(letters), k) for k in range(len(letters) + 1))
    # the session bounds a recursion by rows (a million unless told otherwise)
    if 0 <= int(spark.conf.get(ROW_LIMIT, "1000000")) <= rows:
        spark.conf.set(ROW_LIMIT, rows + 1)
    return stored(spark.sql(_STEPS.replace("{letters}", letters).replace(
        "{last}", str(len(letters) - 1)), cells=by_part), "audit-steps")


def audit_orders(cells: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step. ``shapley`` is what the step's filter
    removes, summed over all orders: a prefix of k letters opens (n - k)! of
    them."""
    n = len(letters)
    steps = prefix_steps(cells, letters)
    weight = F.element_at(F.array(*[F.lit(math.factorial(n - k)) for k in range(1, n + 1)]),
                          F.col("step"))
    shares = steps.groupBy("part", "letter").agg(
        F.sum(F.col("removed") * weight).cast("long").alias("shapley"))
    orders = steps.where(F.col("step") == n).select(
        "part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(n)))
        .alias("at")).withColumn("prefix", F.expr("substring(filter_order, 1, at)"))
    return (orders.join(steps, ["part", "prefix"]).join(shares, ["part", "letter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                    "good_lost", "toxic_lost", "shapley"))


def audit_documents(documents: DataFrame, labels: DataFrame, key: str = "doc_id",
                    text: str = "text", part: str = "lang",
                    filters: Mapping[str, TextFilter] | None = None) -> DataFrame:
    """Metrics of every order and step of the text filters and the identity
    filter, per part."""
    filters = TEXT_FILTERS if filters is None else filters
    return audit_orders(mask_cells(documents, labels, key, text, part, filters),
                        "".join(filters) + IDENTICAL)
