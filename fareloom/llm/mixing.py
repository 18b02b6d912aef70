"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, read up to twice. A copy's virtual
finish time is the words its source has sent with it, over the source's target; merged by finish
time and cut at the total budget, the queues come out in proportion to their targets.

Whole documents rarely end on the target: of the copies behind the cut, each source sends the one
that brings it nearest to its target, if any does.

A source's running total is a prefix sum in two levels, over hash slices of the source and within
a slice, so no task holds a whole source; the cut is found by narrowing a histogram of finish times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareloom.sources.staging import stage

# Weights of the sources in order, repeated; share of all words; most times a word is taken.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_COPIES = 2

SLICES = 4096  # hash slices per source
BINS = 4096  # histogram bins per narrowing of the cut
NARROWINGS = 4

WORD = r"[^\x20\x09-\x0D]+"


def words_in(text_col: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target of each row (source, source_size), by weight with a ceiling.

    With r the words per unit of weight, a source gets min(most * size, r * weight). Sources reach
    their ceiling in order of ceiling per weight; r is what the rest share when no further one does.
    One row per source is sorted in one task: the table of sources, not of documents.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ceiling = F.col("source_size") * float(most)
    ranked = sizes.withColumn(
        "weight", F.element_at(cycle, (F.row_number().over(in_order) - 1) % len(weights) + 1)
    ).withColumns({"ceiling": ceiling, "per_weight": ceiling / F.col("weight")})
    # Sources after this one in order of per_weight, itself included, share what those before leave.
    before = Window.orderBy("per_weight", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy()
    ranked = ranked.withColumns(
        {
            "held": F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)),
            "lighter": F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "weights": F.sum("weight").over(whole),
            "budget": F.sum("source_size").over(whole) * float(budget),
        }
    )
    rate = (F.col("budget") - F.col("held")) / (F.col("weights") - F.col("lighter"))
    ranked = ranked.withColumn("rate", rate)
    # The first that stays under its ceiling sets the rate for itself and all after it.
    open_rate = F.min(F.when(F.col("rate") <= F.col("per_weight"), F.struct("per_weight", "source", "rate")))
    ranked = ranked.withColumn("final", open_rate.over(whole)["rate"])
    target = F.least(F.col("ceiling"), F.coalesce(F.col("final") * F.col("weight"), F.col("ceiling")))
    return ranked.select("source", "source_size", target.alias("target"))


def _spread(docs: DataFrame) -> DataFrame:
    """Columns _size, _key (shuffled order) and _slice of each row."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(6))
    sliced = F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), 64 - 12).cast("int") % SLICES
    return docs.withColumn("_key", key).withColumns({"_size": words_in(), "_slice": sliced})


def queued(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, float]:
    """Rows of `keep` with _size, _before (words of the source sent before), source_size and target;
    and the total budget."""
    rows = _spread(docs).select(*keep, "source", "_key", "_size", "_slice")
    sums = stage(
        _spread(docs).groupBy("source", "_slice").agg(F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_n")),
        "slices",
    )
    sizes = stage(sums.groupBy("source").agg(F.sum("_words").alias("source_size")), "sources")
    goal = stage(targets(sizes), "targets")
    slices = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.withColumn("_ahead", F.coalesce(F.sum("_words").over(slices), F.lit(0)))
    goal = goal.withColumnRenamed("source", "_source")
    ahead = ahead.join(goal, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("source").alias("_source"),
        F.col("_slice").alias("_s"),
        "_ahead",
        "source_size",
        "target",
    )
    inside = Window.partitionBy("source", "_slice").orderBy("_key", "_size", *keep[:1])
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    rows = rows.join(ahead, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_s")))
    rows = rows.withColumn("_before", F.col("_ahead") + F.col("_inside"))
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    return rows.drop("_s", "_source", "_ahead", "_inside", "_slice"), BUDGET * total


def _finish(copy) -> F.Column:
    sent = F.col("source_size") * copy + F.col("_before") + F.col("_size")
    return F.when(F.col("target") > 0, sent / F.col("target"))


def cut_time(rows: DataFrame, budget: float) -> float:
    """The last finish time that is still taken: words up to it stay within the budget.

    `rows` needs _size, _before, source_size and target. Each narrowing is one small histogram of
    the copies inside the bin where the budget is reached; the driver sees BINS numbers.
    """
    copies = rows.filter("_size > 0 and target > 0").select(
        F.explode(F.array(*[_finish(F.lit(k)) for k in range(MOST_COPIES)])).alias("v"), "_size"
    )
    low, high = 0.0, None
    room = budget
    top = copies.agg(F.max("v")).first()[0]
    if top is None:
        return 0.0
    high = float(top) * (1 + 1e-12) + 1e-12
    for _ in range(NARROWINGS):
        width = (high - low) / BINS
        if width <= 0:
            break
        bin_of = F.least(F.floor((F.col("v") - low) / width), F.lit(BINS - 1))
        inside = copies.filter((F.col("v") > low) & (F.col("v") <= high))
        counts = inside.groupBy(bin_of.alias("b")).agg(F.sum("_size").alias("w"), F.max("v").alias("last"))
        hit = None
        done = low
        for r in sorted(counts.collect(), key=lambda r: r["b"]):
            if r["w"] > room:
                hit = r
                break
            room -= r["w"]
            done = r["last"]
        if hit is None:
            return high
        low, high = done, float(hit["last"])
    return low


def with_copies(rows: DataFrame, narrow: DataFrame, cut: float) -> DataFrame:
    """`rows` with _copies, how often each is taken: the copies up to the cut and the last ones.

    `narrow` has the same rows without their texts, as a stored table; the last ones are found there.
    """
    within = [F.coalesce(_finish(F.lit(k)) <= cut, F.lit(False)) for k in range(MOST_COPIES)]
    taken = sum((w.cast("int") for w in within), F.lit(0))
    rows, narrow = (x.withColumn("_copies", taken) for x in (rows, narrow))
    sent = narrow.groupBy("source").agg(
        F.sum(F.col("_size") * F.col("_copies")).alias("sent"), F.max("target").alias("goal")
    )
    gaps = sent.select(F.col("source").alias("_source"), (F.col("goal") - F.col("sent")).alias("_gap"))
    # A row with words is known by its source and the words before it.
    waiting = narrow.filter(f"_size > 0 and _copies < {MOST_COPIES}").select("source", "_before", "_size")
    off = F.abs(F.col("_size") - F.col("_gap"))
    last = (
        waiting.join(gaps.filter("_gap > 0"), F.col("source").eqNullSafe(F.col("_source")))
        .filter(off < F.col("_gap"))
        .groupBy("_source")
        .agg(F.min(F.struct(off.alias("off"), F.col("_before").alias("at"))).alias("m"))
        .select("_source", F.col("m.at").alias("_at"))
    )
    rows = rows.join(last, F.col("source").eqNullSafe(F.col("_source")), "left")
    more = (F.col("_size") > 0) & (F.col("_before") == F.col("_at"))
    return rows.withColumn("_copies", F.col("_copies") + F.coalesce(more, F.lit(False)).cast("int")).drop(
        "_source", "_at"
    )


def mix_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes of it) of every row.

    A null source is a source of its own, last in order; null and empty texts have size 0 and take
    nothing. Repeated rows are documents of their own. Equal finish times are taken or left
    together. An empty table gives an empty result. The same rows give the same mix on each run.
    """
    rows, budget = queued(docs, ["doc_id"])
    rows = stage(rows, "queued")
    rows = with_copies(rows, rows, cut_time(rows, budget))
    return rows.select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: `docs` rows as often as they are taken (not at all, once or twice), in order
    of finish time over range partitions. A document without words is not part of a mix of words."""
    bare = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "source")
    narrow, budget = queued(bare.drop("_row"), ["doc_id"])
    narrow = stage(narrow, "queued")
    rows, _ = queued(bare, ["doc_id", "_row"])
    rows = with_copies(rows, narrow, cut_time(narrow, budget)).filter("_size > 0 and _copies > 0")
    nth = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    rows = rows.select("_row", "_key", "source_size", "_before", "_size", "target", nth.alias("_nth"))
    rows = rows.withColumn("_v", _finish(F.col("_nth")))
    return rows.repartitionByRange("_v", "_key").sortWithinPartitions("_v", "_key").select("_row.*")
