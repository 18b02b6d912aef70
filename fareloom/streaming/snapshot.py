"""The newest row per key, kept up to date from a stream of changes.

Rows are kept by hash bucket of the key and by version, the number of the micro-batch that wrote
them. A batch is reduced to one row per key in its tasks, merged with the buckets it touches, and
written as their next version; the other buckets are not read. Which row is newest does not depend on
the order rows come in, so rows out of order are passed over and a batch run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.sources.staging import remove_path, scratch_path
from fareloom.streaming.window_features import DayTable


class BucketTable(DayTable):
    """A parquet folder by bucket and version."""

    part = "bucket"
    value = int


def newest_rows(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """One row per key: the latest, a null time last; of rows of one time the one greatest by its
    other columns. A max of structs, so tasks combine before the shuffle and a hot key is no burden."""
    rest = [c for c in df.columns if c not in keys and c != ts]
    best = df.groupBy(*keys).agg(F.max(F.struct(ts, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


class Snapshot:
    """The newest row per key under `root`, in a fixed number of buckets.

    Changes must not have columns `bucket` or `version`. More buckets make smaller rewrites where a
    batch touches few keys; the number belongs to the stored table and must stay.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], ts: str, buckets: int = 64):
        self.spark, self.root, self.keys, self.ts, self.buckets = spark, root.rstrip("/"), list(keys), ts, buckets
        self.rows = BucketTable(spark, f"{self.root}/rows")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of changes."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        staged = scratch_path(self.spark, "changes")
        own = newest_rows(batch, self.keys, self.ts).withColumn("bucket", bucket)
        own.write.parquet(staged)
        own = self.spark.read.schema(own.schema).parquet(staged)
        touched = {r[0] for r in own.select("bucket").distinct().collect()}  # at most `buckets`
        if touched:
            self.rows.schema = StructType([f for f in own.schema.fields if f.name != "bucket"])
            old = self.rows.read(touched, below=batch_id)
            if old is not None:
                old = old.withColumn("bucket", bucket)
                own = newest_rows(own.unionByName(old), [*self.keys, "bucket"], self.ts)
            self.rows.write(own, batch_id)
            self.rows.prune(touched)
        remove_path(self.spark, staged)

    def run(self, stream: DataFrame) -> DataFrame:
        """Take in what the stream holds and return the snapshot as it stands."""
        query = (
            stream.writeStream.foreachBatch(self.merge)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self.read(stream.schema)

    def read(self, schema: StructType) -> DataFrame:
        """The newest row of every key seen so far; empty before the first change."""
        found = self.rows.read()
        if found is None:
            return self.spark.createDataFrame([], schema)
        return found.select(*schema.names)
