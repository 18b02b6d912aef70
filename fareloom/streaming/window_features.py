"""The window features as incremental jobs whose tables equal the batch result.

A micro-batch is reduced to pane sums, which can be merged in any order, so no watermark is needed:
rows that come late, however late, re-open the windows they fall into, and the newest windows are
there at once. Two tables are kept, both by day:

    <root>/panes/day=../version=..       one row per key and pane
    <root>/features/day=../version=..    the windows that end on that day

A version is the number of the micro-batch that wrote it. Batch b merges its sums with the newest
version below b of the days it touches and writes version b; then it writes the windows of those
days anew from the panes. A batch that is run again after a failure, at whatever point that was,
therefore reads what it read before and replaces its own versions: nothing is counted twice. Folders
in use are never overwritten. Only days that a batch touches are read or written; two versions of a
day are kept, the older ones are removed.

The checkpoint numbers the batches: it and the tables belong together and live under one root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.operators.time_features import (
    sliding_from_panes,
    sliding_panes,
    tumbling_from_panes,
    tumbling_panes,
)
from fareloom.sources.staging import list_paths, remove_path, scratch_path

KEPT_VERSIONS = 2


@dataclass(frozen=True)
class WindowFeature:
    """How trips become panes and panes become windows."""

    panes: Callable[[DataFrame, str], DataFrame]
    windows: Callable[[DataFrame, str], DataFrame]
    sums: tuple[str, ...]
    days_ahead: int  # days after a pane's that its windows may end on


SLIDING = WindowFeature(sliding_panes, sliding_from_panes, ("fares", "priced", "trips"), 1)
TUMBLING = WindowFeature(tumbling_panes, tumbling_from_panes, ("trips",), 0)


class DayTable:
    """A parquet folder by day and version; a day is read in its newest version."""

    part = "day"
    value = staticmethod(date.fromisoformat)

    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None):
        self.spark, self.path, self.schema = spark, path, schema

    def versions(self) -> dict[date, list[int]]:
        """Versions of each day, in order, from the folders' names."""
        found: dict[date, list[int]] = {}
        for path in list_paths(self.spark, f"{self.path}/{self.part}=*/version=*"):
            day, version = (part.split("=")[1] for part in path.rsplit("/", 2)[1:])
            found.setdefault(self.value(day), []).append(int(version))
        return {day: sorted(own) for day, own in found.items()}

    def read(self, days: Iterable[date] | None = None, below: int | None = None) -> DataFrame | None:
        """Those days (all, if none are named) in their newest version below `below`; None without any."""
        found = self.versions()
        newest = {
            day: [v for v in own if below is None or v < below][-1:]
            for day, own in found.items()
            if days is None or day in days
        }
        paths = [f"{self.path}/{self.part}={day}/version={v[0]}" for day, v in newest.items() if v]
        if not paths:
            return None
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(*paths)

    def write(self, rows: DataFrame, version: int) -> None:
        """`rows` (with column `day`) as that version of their days; written again, it is replaced."""
        (
            rows.withColumn("version", F.lit(version))
            .hint("rebalance", F.col(self.part))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.part, "version")
            .parquet(self.path)
        )

    def prune(self, days: Iterable[date]) -> None:
        for day, own in self.versions().items():
            if day in days:
                for version in own[:-KEPT_VERSIONS]:
                    remove_path(self.spark, f"{self.path}/{self.part}={day}/version={version}")


class FeatureStream:
    """Window features kept up to date from a stream of trips."""

    def __init__(self, spark: SparkSession, root: str, feature: WindowFeature, ts: str):
        self.spark, self.root, self.feature, self.ts = spark, root.rstrip("/"), feature, ts
        self.panes = DayTable(spark, f"{self.root}/panes")
        self.features = DayTable(spark, f"{self.root}/features")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of trips. The same batch again leaves the tables as they are."""
        feature = self.feature
        own = feature.panes(batch, self.ts).withColumn("day", F.to_date("pane_end"))
        staged = scratch_path(self.spark, "panes")
        own.write.parquet(staged)  # the batch is read once
        own = self.spark.read.schema(own.schema).parquet(staged)
        days = {r[0] for r in own.select("day").distinct().collect()}
        if not days:
            return
        self.panes.schema = StructType([f for f in own.schema.fields if f.name != "day"])
        old = self.panes.read(days, below=batch_id)
        if old is not None:
            own = own.unionByName(old.withColumn("day", F.to_date("pane_end")))
        merged = own.groupBy("zip", "pane_end", "day").agg(*[F.sum(c).alias(c) for c in feature.sums])
        self.panes.write(merged.select(*own.columns), batch_id)

        touched = {day + timedelta(days=k) for day in days for k in range(feature.days_ahead + 1)}
        sources = {day - timedelta(days=k) for day in touched for k in range(feature.days_ahead + 1)}
        windows = feature.windows(self.panes.read(sources, below=batch_id + 1), self.ts)
        windows = windows.withColumn("day", F.to_date(self.ts))
        self.features.write(windows.filter(F.col("day").isin(list(touched))), batch_id)
        self.panes.prune(days)
        self.features.prune(touched)
        remove_path(self.spark, staged)

    def run(self, stream: DataFrame) -> DataFrame:
        """Take in what the stream holds and return the features as they stand."""
        query = (
            stream.writeStream.foreachBatch(self.merge)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self.read(stream)

    def read(self, trips: DataFrame) -> DataFrame:
        """All windows written so far; empty before the first trip (`trips` gives the columns)."""
        found = self.features.read()
        if found is None:
            none = self.spark.createDataFrame([], trips.schema)
            return self.feature.windows(self.feature.panes(none, self.ts), self.ts)
        return found
