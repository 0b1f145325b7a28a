"""Mixing sources to target weights by hierarchical budgets.

Leaves of a domain-language-source tree hold documents. A token budget is
handed down the tree in proportion to integer weights; a node never gets more
than its leaves can give (their tokens times the epochs allowed), and what a
node cannot take goes to its siblings in proportion to their weights, so a
shortage reaches a node's ancestors only when all its siblings are full.
Every leaf then takes whole epochs while its budget lasts and, from the epoch
after them, the prefix of documents in seeded order whose tokens fit.

The prefix is found without ordering a whole leaf: tokens are summed per
leaf and 12-bit prefix of the order hash, the 4096 sums of a leaf locate the
bucket in which the budget ends, and only that bucket's documents are ordered.
The decision is then one hash bound per leaf.

Defined cases: null levels form the level ``unknown``; null and empty texts
cost nothing and follow their place in the order; rows of one key share a
place and are taken together; a level value without a weight has the level's
default; weight 0 takes nothing; an empty table gives an empty result. Only
the named columns are read for the budget, and ``mixed_documents`` returns
the input's own columns, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import n_blank_words
from .tables import join_small, stored

HEX_PREFIX = 3          # hex digits of the order hash that name a bucket


@dataclass(frozen=True)
class Level:
    """One level of the tree: its value, weights by value, default weight."""

    name: str
    value: Column
    weights: Mapping[str, int] = field(default_factory=dict)
    default: int = 1

    def weight(self) -> Column:
        out = F.lit(self.default)
        for v, w in self.weights.items():
            out = F.when(F.col(self.name) == v, F.lit(w)).otherwise(out)
        return out.cast("long")


def order_hash(seed: int, epoch: Column, key: Column) -> Column:
    """Place of a document in an epoch's seeded order (hex text)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(key.cast("string"), F.lit(""))))


def split_budget(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """``budget`` of the parent in each row -> share of each child.

    Children are ordered by capacity per weight; a child is full when its
    capacity is no more than its share of what the fuller ones before it
    leave. The others divide the rest by weight (whole tokens, rounded down).
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(0.0))
    key = [F.col(c) for c in parent] or [F.lit(0)]
    ordered = Window.partitionBy(*key).orderBy(ratio, name)
    whole = Window.partitionBy(*key)
    before = F.coalesce(F.sum("capacity").over(
        ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_on = F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    marked = children.withColumn("full", F.col("capacity") * weight_on
                                 <= F.col("weight") * (F.col("budget") - before))
    rest = F.col("budget") - F.coalesce(
        F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    share = F.when(F.col("full"), F.col("capacity")).otherwise(
        F.floor((F.col("weight") * rest) / F.when(open_weight > 0, open_weight)))
    out = marked.select("*", F.coalesce(share, F.lit(0)).cast("long").alias("share"))
    return out.drop("budget", "full").withColumnRenamed("share", "budget")


def leaf_budgets(leaves: DataFrame, levels: Sequence[Level], budget_share: float,
                 max_epochs: int) -> DataFrame:
    """Budget of every leaf from (levels..., available)."""
    names = [x.name for x in levels]
    caps = leaves.select(*names, "available", *[x.weight().alias(f"w{i}")
                                                 for i, x in enumerate(levels)])
    usable = F.lit(True)
    for i in range(len(levels)):
        usable = usable & (F.col(f"w{i}") > 0)
    caps = caps.withColumn("capacity", F.when(
        usable, F.col("available") * max_epochs).otherwise(F.lit(0)).cast("long"))
    given = caps.agg(F.floor(F.coalesce(F.sum("available"), F.lit(0)) * F.lit(budget_share))
                     .cast("long").alias("total")).scalar()
    parent_budget = None
    for i, level in enumerate(levels):
        parent, own = names[:i], names[:i + 1]
        nodes = caps.groupBy(*own).agg(F.sum("capacity").alias("capacity"),
                                       F.max(f"w{i}").alias("weight"))
        if parent_budget is None:
            nodes = nodes.withColumn("budget", F.least(given, F.sum("capacity").over(
                Window.partitionBy(F.lit(0)))))
        else:
            nodes = nodes.join(parent_budget, parent)
        parent_budget = split_budget(nodes, parent, level.name).select(*own, "budget")
    return caps.select(*names, "available").join(parent_budget, names).select(
        *names, "available", "budget",
        F.when(F.col("available") > 0, F.floor(F.col("budget") / F.col("available")))
        .otherwise(F.lit(0)).cast("long").alias("epochs")).withColumn(
        "rest", F.col("budget") - F.col("epochs") * F.col("available"))


@dataclass(frozen=True)
class Plan:
    """What each leaf takes, and the table it was computed from."""

    leaves: DataFrame      # levels..., available, budget, epochs, rest, bound
    n_leaves: int
    records: DataFrame     # doc_id, levels..., tokens


def plan_mixture(documents: DataFrame, levels: Sequence[Level], budget_share: float = 1.0,
                 max_epochs: int = 1, seed: int = 0, key: str = "doc_id", text: str = "text",
                 tokens: Column | None = None) -> Plan:
    """Budgets and order bounds of all leaves, from all documents."""
    names = [x.name for x in levels]
    tokens = n_blank_words(F.col(text)) if tokens is None else tokens
    records = stored(documents.select(
        F.col(key).alias("doc_id"), tokens.cast("long").alias("tokens"),
        *[F.coalesce(x.value, F.lit("unknown")).alias(x.name) for x in levels]), "mix-records")
    leaves = records.groupBy(*names).agg(F.sum("tokens").alias("available"))
    budgets = stored(leaf_budgets(leaves, levels, budget_share, max_epochs), "mix-budgets")
    n_leaves = budgets.count()

    placed = join_small(records, budgets.select(*names, "epochs", "rest"), names, "doc_id",
                        rows=n_leaves)
    placed = placed.select(*names, "tokens", "rest",
                           order_hash(seed, F.col("epochs"), F.col("doc_id")).alias("h"))
    placed = placed.withColumn("bucket", F.substring("h", 1, HEX_PREFIX))
    sums = placed.groupBy(*names, "bucket").agg(F.sum("tokens").alias("tokens"),
                                                F.max("rest").alias("rest"))
    upto = Window.partitionBy(*names).orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, 0)
    ends = (sums.withColumn("upto", F.sum("tokens").over(upto))
            .where(F.col("upto") > F.col("rest"))
            .groupBy(*names).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("tokens"))
                                                .alias("before"))).alias("at"))
            .select(*names, "at.bucket", "at.before"))
    ends = stored(ends, "mix-ends")
    last = join_small(placed, ends, [*names, "bucket"], "h", rows=n_leaves)
    running = F.sum("tokens").over(Window.partitionBy(*names).orderBy("h"))
    inside = (last.withColumn("upto", F.col("before") + running)
              .where(F.col("upto") <= F.col("rest"))
              .groupBy(*names).agg(F.max("h").alias("last_h")))
    bounds = budgets.join(ends.select(*names, "bucket"), names, "left").join(
        inside, names, "left").select(
        *names, "available", "budget", "epochs", "rest",
        # no bucket: the rest covers the whole epoch, which only an empty leaf shows
        F.coalesce("last_h", "bucket", F.lit("g")).alias("bound"))
    return Plan(stored(bounds, "mix-bounds"), n_leaves, records)


def _taken(rows: DataFrame, seed: int, key: str) -> Column:
    part = order_hash(seed, F.col("__epochs"), F.col(key)) <= F.col("__bound")
    return F.col("__epochs") + F.when(part, F.lit(1)).otherwise(F.lit(0))


def epochs_of(plan: Plan, levels: Sequence[Level], seed: int = 0) -> DataFrame:
    """One row per document and epoch in which it is taken."""
    names = [x.name for x in levels]
    small = plan.leaves.select(*names, F.col("epochs").alias("__epochs"),
                               F.col("bound").alias("__bound"), F.col("budget").alias("leaf_budget"))
    rows = join_small(plan.records, small, names, "doc_id", rows=plan.n_leaves)
    taken = rows.withColumn("__n", _taken(rows, seed, "doc_id")).where(F.col("__n") > 0)
    return taken.select("doc_id", *names, "tokens", "leaf_budget",
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))
                        .alias("epoch"))


def mixed_documents(documents: DataFrame, plan: Plan, levels: Sequence[Level], seed: int = 0,
                    key: str = "doc_id") -> DataFrame:
    """The documents taken in at least one epoch, once each, as they came."""
    columns = documents.columns
    made = [f"__level{i}" for i in range(len(levels))]
    small = plan.leaves.select(*[F.col(x.name).alias(m) for x, m in zip(levels, made)],
                               F.col("epochs").alias("__epochs"), F.col("bound").alias("__bound"))
    rows = documents.select("*", *[F.coalesce(x.value, F.lit("unknown")).alias(m)
                                   for x, m in zip(levels, made)])
    rows = join_small(rows, small, made, key, rows=plan.n_leaves)
    return rows.where(_taken(rows, seed, key) > 0).select(*columns)


def corpus_levels() -> tuple[Level, ...]:
    """Tree and weights of the registered query and of the pipeline."""
    source = F.col("source")
    domain = (F.when(source == "src0", F.lit("hub"))
              .when(source.rlike("^src[1-9]$"), F.lit("wide"))
              .when(source.isNotNull(), F.lit("tail")))
    return (Level("domain", domain, {"hub": 30, "wide": 40, "tail": 30}, 5),
            Level("language", F.col("lang"), {"en": 50, "de": 20, "fr": 15, "es": 15}, 5),
            Level("origin", source))
