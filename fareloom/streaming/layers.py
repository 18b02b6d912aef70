"""The bronze, silver and gold layers as triggered streaming runs.

Each layer is a parquet folder that the next one reads as a stream. A run processes what has
arrived and stops (`availableNow`); its checkpoint lets the next run, or a restart after a
failure, continue where it ended.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from fareloom.operators.time_features import dropoff_trip_count, pickup_zip_avg
from fareloom.plans import medallion
from fareloom.sources.readers import stream_path


# Layers whose every version is the whole result.
REPLACED = ("trip_pickup_features", "trip_dropoff_counts")


class LayerStore:
    """Where the layers and their checkpoints live.

    A backlog is worked off in batches of `max_files`, so that a failure repeats one batch only.
    """

    def __init__(self, spark: SparkSession, root: str, max_files: int = 10_000):
        self.spark, self.root, self.max_files = spark, root.rstrip("/"), max_files
        self.schemas: dict[str, StructType] = {}  # of the layers run so far

    def path(self, name: str) -> str:
        return f"{self.root}/layers/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def read(self, name: str) -> DataFrame:
        """The layer as it stands. One that has run but had no input yet is empty."""
        schema = self.schemas.get(name)
        try:
            reader = self.spark.read.schema(schema) if schema else self.spark.read
            return reader.parquet(self.path(name))
        except AnalysisException as e:
            if schema and e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def stream(self, name: str) -> DataFrame:
        """New rows of the layer."""
        schema = self.schemas[name] if name in self.schemas else self.read(name).schema
        return stream_path(
            self.spark,
            self.path(name),
            schema,
            max_files_per_trigger=self.max_files,
        )

    def current_path(self, name: str) -> str:
        """Newest version of a layer that is replaced as a whole."""
        newest = self.read(name).agg(F.max("version")).first()[0]
        return f"{self.path(name)}/version={newest}"

    def current(self, name: str) -> DataFrame:
        every = self.read(name)
        if every.isEmpty():
            return every.drop("version")
        return self.spark.read.parquet(self.current_path(name))

    def register(self, database: str) -> None:
        """Make the layers catalog tables with their comments and properties.

        The tables are external: dropping the old entry to point it at a new version leaves the
        data alone. Call after each update.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for layer in medallion.LAYERS.values():
            path = self.current_path if layer.name in REPLACED else self.path
            properties = ", ".join(f"'{k}' = '{v}'" for k, v in layer.properties.items())
            table = f"`{database}`.`{layer.name}`"
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(
                f"CREATE TABLE {table} USING parquet LOCATION '{path(layer.name)}'"
                f" COMMENT '{layer.comment}' TBLPROPERTIES ({properties})"
            )


def append_layer(store: LayerStore, name: str, stream: DataFrame) -> None:
    """Run a stateless step to the end of its input."""
    store.schemas[name] = stream.schema
    query = (
        stream.writeStream.format("parquet")
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", store.checkpoint(name))
        .trigger(availableNow=True)
        .start(store.path(name))
    )
    query.awaitTermination()


def replace_layer(store: LayerStore, name: str, stream: DataFrame) -> None:
    """Run an unbounded aggregate; every batch writes the whole result as a new version.

    The version is the batch's number, so a batch that is run again replaces its own version. A
    version's folder is moved into place when its job commits: readers never see half of one.
    """

    store.schemas[name] = StructType(
        [*stream.schema.fields, StructField("version", IntegerType())]
    )

    def put(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("version", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("version")
            .parquet(store.path(name))
        )

    query = (
        stream.writeStream.foreachBatch(put)
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", store.checkpoint(name))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_bronze(store: LayerStore, raw: DataFrame) -> None:
    append_layer(store, "bronze_nyc_taxi", medallion.bronze(raw))


def run_silver(store: LayerStore) -> None:
    append_layer(store, "silver_nyc_taxi", medallion.silver(store.stream("bronze_nyc_taxi")))


def run_pickup(store: LayerStore) -> None:
    replace_layer(store, "trip_pickup_features", pickup_zip_avg(store.stream("silver_nyc_taxi")))


def run_dropoff(store: LayerStore) -> None:
    silver = store.stream("silver_nyc_taxi")
    append_layer(store, "trip_dropoff_features", medallion.dropoff_rows(silver))


def run_dropoff_counts(store: LayerStore) -> None:
    """Trips per drop-off ZIP, kept incrementally."""
    rows = store.stream("trip_dropoff_features")
    replace_layer(store, "trip_dropoff_counts", dropoff_trip_count(rows))


def run_gold(store: LayerStore) -> None:
    """Stream-static join. The per-ZIP tables are complete and small files by now, and each
    silver row is joined once, with their state of this run."""
    append_layer(
        store,
        "gold_nyc_taxi",
        medallion.gold(
            store.stream("silver_nyc_taxi"),
            store.current("trip_pickup_features"),
            store.current("trip_dropoff_counts"),
        ),
    )


def run_all(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    upto: str = "gold_nyc_taxi",
    max_files: int = 10_000,
) -> LayerStore:
    """One triggered update, upstream layers first, ending with `upto`."""
    store = LayerStore(spark, root, max_files)
    steps = {
        "bronze_nyc_taxi": lambda: run_bronze(store, raw),
        "silver_nyc_taxi": lambda: run_silver(store),
        "trip_pickup_features": lambda: run_pickup(store),
        "trip_dropoff_features": lambda: run_dropoff(store),
        "trip_dropoff_counts": lambda: run_dropoff_counts(store),
        "gold_nyc_taxi": lambda: run_gold(store),
    }
    if upto not in steps:
        raise KeyError(f"no layer {upto}")
    for name, run in steps.items():
        run()
        if name == upto:
            break
    return store
