"""Point-in-time feature lookup and training sets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.functions.timefn import epoch_micros
from fareloom.sources.staging import stage

HOUR = 3600


@dataclass(frozen=True)
class FeatureLookup:
    """Which features to fetch, and by which columns of the two sides.

    Keys pair up by position: `lookup_key[i]` of the rows is matched with `table_key[i]`.
    """

    table: DataFrame
    features: Sequence[str]
    lookup_key: Sequence[str]
    table_key: Sequence[str]
    lookup_ts: str
    table_ts: str
    # Stretch of time a task works on. None: one task per key, for lookup times that are rounded.
    chunk_seconds: int | None = HOUR
    names: Sequence[str] = field(default=())


def _resolve(asked: DataFrame, known: DataFrame, keys: list[str], chunk: int | None) -> DataFrame:
    """The newest known feature at or before each asked (key, time)."""
    no_feature = F.lit(None).cast(known.schema["_f"].dataType)
    parts = list(keys)
    if chunk is not None:
        at = F.floor(epoch_micros("_t") / F.lit(chunk * 1_000_000)).cast("long")
        asked, known = asked.withColumn("_c", at), known.withColumn("_c", at)
        parts.append("_c")
    both = asked.select("*", no_feature.alias("_f"), F.lit(1).alias("_asked")).unionByName(
        known.withColumn("_asked", F.lit(0))
    )
    # A feature at the very time asked for counts, hence known rows sort first.
    sofar = (
        W.partitionBy(*parts)
        .orderBy("_t", "_asked")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    found = both.withColumn("_f", F.last("_f", ignorenulls=True).over(sofar)).filter("_asked = 1")
    if chunk is None:
        return found.select(*keys, "_t", "_f")

    # What each stretch starts with: the last feature of the stretches before it.
    lasts = known.groupBy(*parts).agg(F.max_by("_f", "_t").alias("_last"))
    stretches = asked.select(*parts).distinct()
    spans = stretches.select("*", no_feature.alias("_last"), F.lit(1).alias("_asked")).unionByName(
        lasts.withColumn("_asked", F.lit(0))
    )
    before = W.partitionBy(*keys).orderBy("_c").rangeBetween(W.unboundedPreceding, -1)
    carried = (
        spans.withColumn("_carry", F.last("_last", ignorenulls=True).over(before))
        .filter("_asked = 1")
        .select(*parts, "_carry")
    )
    return found.join(carried, parts, "left").select(
        *keys, "_t", F.coalesce("_f", "_carry").alias("_f")
    )


def asof_lookup(
    df: DataFrame,
    lookup: FeatureLookup,
    staged: bool = False,
    asked_of: DataFrame | None = None,
) -> DataFrame:
    """Add to each row the newest features with `table_ts <= lookup_ts` of its key.

    No match gives NULLs. The features travel as one struct, so a NULL feature in the newest
    row stays NULL instead of being filled from an older one.

    Only the distinct (key, time) pairs asked for go through the sort; rows pick their answer up
    by an equi join, which the runtime can split however many rows share a pair. Long histories
    of one key are worked on in stretches of `chunk_seconds` (see `_resolve`). `asked_of` is
    where the pairs are taken from, `df` if not given; a chain of lookups passes its plain input.

    `staged` writes the answers out first, so that they are broadcast when they are measured to
    be small. Worth it for rounded times, of which there are few; pairs of unrounded times are
    about as many as the rows.
    """
    keys = [f"_k{i}" for i in range(len(lookup.lookup_key))]
    names = list(lookup.names or lookup.features)
    source = df if asked_of is None else asked_of
    asked = source.select(
        *[F.col(c).alias(k) for c, k in zip(lookup.lookup_key, keys)],
        F.col(lookup.lookup_ts).cast("timestamp_ntz").alias("_t"),
    )
    asked = asked.dropna().distinct()
    known = lookup.table.select(
        *[F.col(c).alias(k) for c, k in zip(lookup.table_key, keys)],
        F.col(lookup.table_ts).cast("timestamp_ntz").alias("_t"),
        F.struct(*[F.col(f).alias(n) for f, n in zip(lookup.features, names)]).alias("_f"),
    ).dropna(subset=[*keys, "_t"])
    answers = _resolve(asked, known, keys, lookup.chunk_seconds)
    if staged:
        answers = stage(answers, "asof")
    on = F.col(lookup.lookup_ts).cast("timestamp_ntz") == F.col("_t")
    for c, k in zip(lookup.lookup_key, keys):
        on = on & (F.col(c) == F.col(k))
    return df.join(answers, on, "left").select(
        *[F.col(c) for c in df.columns], *[F.col(f"_f.{n}").alias(n) for n in names]
    )


def create_training_set(
    df: DataFrame,
    lookups: Sequence[FeatureLookup],
    label: str | None = None,
    exclude: Sequence[str] = (),
    staged: bool = False,
) -> DataFrame:
    """All lookups in turn, then the excluded columns dropped. The label stays."""
    if label is not None and label not in df.columns:
        raise ValueError(f"label {label} is not a column of the input")
    plain = df
    for lookup in lookups:
        df = asof_lookup(df, lookup, staged, asked_of=plain)
    return df.drop(*[c for c in exclude if c != label])


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest row per key. Each task keeps one row per key before the shuffle."""
    newest = W.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")
