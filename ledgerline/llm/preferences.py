"""Preference formatting of conversation pairs.

A pair is a chosen and a rejected conversation. Their longest common turn
prefix (same role and text, turn by turn) is rendered once as the prompt; the
turns after it are rendered as two completions, each with a mask: the spans
of characters an assistant wrote, which are the ones to learn from.

Turns meet by place: both conversations' turns are joined on (pair, place),
the first place at which they differ ends the prefix, and each side's turns
are put together per pair. A group is one pair, so its size is that of two
conversations.

Defined cases: a null role or text counts as an empty one; turns are ordered
by (turn, role, text), so ties and repeated rows keep one order; a pair
without a common turn has an empty prompt, one whose conversations are equal
has two empty completions; a conversation that is missing has no turns; an
empty table gives an empty result; only the named columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

LEARNED_ROLE = "assistant"


def rendered(role: Column, text: Column) -> Column:
    """One turn as text."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def ordered_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, role, text): places count from 0 without gaps."""
    rows = turns.select(F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "role", "text")


def _ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one sorted range: ``at`` counts its rows, ``run`` its different values
    of ``same`` and ``rank`` the rows of each, all but ``rank`` from 0."""
    at, run, rank, last = -1, -1, 0, None
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        for value in batch.column("same").to_pylist():
            at += 1
            run, rank = (run, rank + 1) if run >= 0 and value == last else (run + 1, 1)
            last = value
            out.append((at, run, rank))
        columns = [pa.array([x[i] for x in out], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns],
                                         names=[*batch.schema.names, "at", "run", "rank"])


def _two_by_two(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """(n, two): ``rows`` (conv_id, learned, same and what ``order`` names) in
    order, those of equal ``same`` taken two by two; ``two`` holds one row where
    their number is odd. Equal values of ``same`` have to be neighbours.

    Rows are sorted in ranges, and the driver gets a few values of each range
    to carry counts over its edge, so no task gets more than a range however
    many rows are alike."""
    spark = rows.sparkSession
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.spark_partition_id().cast("long").alias("part"), "conv_id", "learned", "same")
    kind = dict(rows.dtypes)["conv_id"]
    seen = stored(ranges.mapInArrow(
        _ranks, f"part long, conv_id {kind}, learned long, same string, at long, run long, rank long"),
        name)
    edges, before, open_rank, open_same = [], 0, 0, None
    for r in seen.groupBy("part").agg(
            F.count(F.lit(1)).alias("rows"), F.max("run").alias("runs"),
            F.min_by("same", "at").alias("first"), F.max_by("same", "at").alias("last"),
            F.max_by("rank", "at").alias("rank")).orderBy("part").collect():
        carried = open_rank if before and r["first"] == open_same else 0
        edges.append((r["part"], before, carried))
        before += r["rows"]
        open_rank, open_same = r["rank"] + (0 if r["runs"] else carried), r["last"]
    rank = F.col("rank") + F.when(F.col("run") == 0, F.col("carried")).otherwise(F.lit(0))
    numbered = seen.join(F.broadcast(spark.createDataFrame(
        edges, "part long, before long, carried long")), "part").select(
        (F.col("before") + F.col("at")).alias("n"), rank.alias("rank"), "conv_id", "learned")
    return stored(numbered.groupBy((F.col("n") - F.pmod(F.col("rank") - 1, F.lit(2))).alias("n"))
                  .agg(F.sort_array(F.collect_list(F.struct(
                      F.col("n").alias("n"), "conv_id", "learned"))).alias("two")), name)


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id) from ordered turns of a table that
    names no pairs: conversations of the same opening turn, whatever their
    ids, are taken two by two, in order of their ids. The ones left, at most
    one of an opening, are taken two by two in order of their openings, so at
    most one conversation of the table stays alone.

    Chosen is the one with more assistant text, the first in order if equal.
    A null id is in no pair.
    """
    learned = F.when(F.col("role") == LEARNED_ROLE, F.length("text")).otherwise(F.lit(0))
    opens = F.col("place") == 0
    talks = turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(
        F.min(F.when(opens, F.col("role"))).alias("opening_role"),
        F.min(F.when(opens, F.col("text"))).alias("opening"), F.sum(learned).alias("learned"))
    alike = F.sha2(F.concat_ws(":", F.length("opening_role").cast("string"), "opening_role",
                               "opening"), 256)
    first_round = _two_by_two(talks.withColumn("same", alike),
                              ["opening_role", "opening", "conv_id"], "openings")
    left = first_round.where(F.size("two") == 1).select(
        "n", F.col("two")[0]["conv_id"].alias("conv_id"),
        F.col("two")[0]["learned"].alias("learned"), F.lit("").alias("same"))
    paired = first_round.unionByName(_two_by_two(left, ["n"], "left-over")).where(
        F.size("two") == 2)
    one, other = F.col("two")[0], F.col("two")[1]
    first = one["learned"] >= other["learned"]
    return paired.select(
        one["conv_id"].alias("pair_id"),
        F.when(first, one["conv_id"]).otherwise(other["conv_id"]).alias("chosen_id"),
        F.when(first, other["conv_id"]).otherwise(one["conv_id"]).alias("rejected_id"))


def _joined(of: Column) -> Column:
    """Turns of one side, in order, as one text."""
    return F.array_join(F.transform(of, lambda x: rendered(x["role"], x["text"])), "")


def _mask(of: Column) -> Column:
    """``start-end`` spans of assistant text in the joined turns."""
    head = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["role"]) + 5
        end = start + F.length(x["text"])
        span = F.concat_ws("-", start.cast("string"), end.cast("string"))
        return F.struct((end + 1).alias("at"),
                        F.when(x["role"] == LEARNED_ROLE, F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).alias("spans"))
    return F.array_join(F.aggregate(of, head, step, lambda s: s["spans"]), ",")


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """Prompt, completions and masks of every pair, from ordered turns."""
    def side(name: str) -> DataFrame:
        return pairs.select("pair_id", F.col(f"{name}_id").alias("conv_id")).join(
            turns, "conv_id").select("pair_id", "place", F.struct("place", "role", "text")
                                     .alias(name))

    both = side("chosen").join(side("rejected"), ["pair_id", "place"], "full_outer")
    same = (F.coalesce(F.col("chosen.role") == F.col("rejected.role"), F.lit(False))
            & F.coalesce(F.col("chosen.text") == F.col("rejected.text"), F.lit(False)))
    grouped = both.groupBy("pair_id").agg(
        F.min(F.when(~same, F.col("place"))).alias("differs"),
        F.sort_array(F.collect_list("chosen")).alias("chosen_turns"),
        F.sort_array(F.collect_list("rejected")).alias("rejected_turns"))
    n_prompt = F.coalesce(F.col("differs"), F.size("chosen_turns"))
    cut = pairs.join(grouped, "pair_id", "left").select(
        "pair_id", "chosen_id", "rejected_id", F.coalesce(n_prompt, F.lit(0)).alias("n_prompt"),
        *[F.coalesce(c, F.array().cast("array<struct<place:int,role:string,text:string>>")).alias(c)
          for c in ("chosen_turns", "rejected_turns")])
    rest = {s: F.filter(f"{s}_turns", lambda x: x["place"] >= F.col("n_prompt"))
            for s in ("chosen", "rejected")}
    return cut.select(
        "pair_id", "chosen_id", "rejected_id", F.col("n_prompt").cast("long").alias("n_prompt"),
        _joined(F.filter("chosen_turns", lambda x: x["place"] < F.col("n_prompt"))).alias("prompt"),
        _joined(rest["chosen"]).alias("chosen"), _mask(rest["chosen"]).alias("chosen_mask"),
        _joined(rest["rejected"]).alias("rejected"), _mask(rest["rejected"]).alias("rejected_mask"))
