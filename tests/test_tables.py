import os
from datetime import datetime as dt

import pytest

from fareloom.operators.compare import frames_equal
from fareloom.sources import readers, tables
from fareloom.session import partitions_for
from fareloom.sources.staging import release, scratch_path, shared_folder, stage

ROWS = "zip int, at timestamp_ntz, yyyy_mm string, n int"


def rows(spark, *items):
    return spark.createDataFrame([(z, dt(2024, m, 1), f"2024-{m:02d}", n) for z, m, n in items], ROWS)


def stored(table, spark):
    return sorted((r["zip"], r["yyyy_mm"], r["n"]) for r in table.read(spark).collect())


def test_upsert_replaces_inserts_and_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    table = tables.create_feature_table(path, " zip , at", "at", rows(spark, (1, 1, 10), (2, 1, 20), (1, 2, 30)))
    assert table.primary_key == ["zip", "at"]
    source = rows(spark, (1, 1, 11), (3, 1, 40), (1, 3, 50))
    want = [(1, "2024-01", 11), (1, "2024-02", 30), (1, "2024-03", 50), (2, "2024-01", 20), (3, "2024-01", 40)]
    for _ in range(2):
        tables.upsert_feature_table(table, source)
        assert stored(table, spark) == want


def test_upsert_leaves_other_months_alone(spark, tmp_path):
    path = tmp_path / "t"
    table = tables.create_feature_table(str(path), "zip", "at", rows(spark, (1, 1, 1), (1, 2, 2)))
    before = {p.name for p in (path / "yyyy_mm=2024-02").glob("*.parquet")}
    tables.upsert_feature_table(table, rows(spark, (1, 1, 9)))
    assert {p.name for p in (path / "yyyy_mm=2024-02").glob("*.parquet")} == before


def test_duplicate_keys_are_refused(spark, tmp_path):
    twice = rows(spark, (1, 1, 1), (1, 1, 2))
    with pytest.raises(tables.DuplicateKeyError):
        tables.create_feature_table(str(tmp_path / "t"), "zip", "at", twice)
    table = tables.create_feature_table(str(tmp_path / "u"), "zip", "at", rows(spark, (1, 1, 1)))
    with pytest.raises(tables.DuplicateKeyError):
        tables.upsert_feature_table(table, twice)
    assert stored(table, spark) == [(1, "2024-01", 1)]


def test_creating_again_is_a_no_op_but_other_columns_conflict(spark, tmp_path):
    path = str(tmp_path / "t")
    table = tables.create_feature_table(path, "zip", "at", rows(spark, (1, 1, 1)))
    tables.create_feature_table(path, "zip", "at", rows(spark, (5, 1, 5)))
    assert stored(table, spark) == [(1, "2024-01", 1)]
    with pytest.raises(tables.SchemaConflictError):
        tables.create_feature_table(path, "zip", "at", rows(spark, (1, 1, 1)).withColumnRenamed("n", "m"))
    with pytest.raises(ValueError):
        tables.create_feature_table(path, "zip", "at", rows(spark, (1, 1, 1)).drop("yyyy_mm"))


def test_month_filter_prunes_partitions(spark, tmp_path, capsys):
    table = tables.create_feature_table(str(tmp_path / "t"), "zip", "at", rows(spark, (1, 1, 1), (1, 2, 2)))
    table.read(spark).filter("yyyy_mm = '2024-02'").explain()
    assert "PartitionFilters: [isnotnull(yyyy_mm" in capsys.readouterr().out


def test_catalog_tables_and_schema(spark, tmp_path):
    assert tables.create_schema(spark, "main.fares.predictions") == "fares"
    tables.create_schema(spark, "main.fares.predictions")
    with pytest.raises(ValueError):
        tables.create_schema(spark, "predictions")
    tables.overwrite_table(spark.range(3), "fares.predictions")
    tables.overwrite_table(spark.range(2).withColumnRenamed("id", "other"), "fares.predictions")
    assert readers.read_table(spark, "fares.predictions").columns == ["other"]
    tables.overwrite_table(spark.range(4), "fares.elsewhere", str(tmp_path / "x"))
    assert readers.read_table(spark, "fares.elsewhere").count() == 4


def test_overwrite_path_replaces_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.overwrite_path(spark.range(3), path)
    tables.overwrite_path(spark.range(2).selectExpr("id AS a", "id AS b"), path)
    assert spark.read.parquet(path).columns == ["a", "b"]


def test_readers(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(5).write.parquet(path)
    assert readers.read_path(spark, path).count() == 5
    assert readers.read_path_sql(spark, path).count() == 5
    tables.register_view(spark.range(5), "five")
    assert readers.read_sql(spark, "SELECT * FROM five WHERE id > 2").count() == 2
    for empty in ("", "  ", None):
        with pytest.raises(ValueError):
            readers.read_sql(spark, empty)
    assert readers.from_rows(spark, [(1, "a")], "i int, s string").first()["s"] == "a"


def test_staging_uses_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    df = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS s")
    kept = stage(df, "numbers")
    assert frames_equal(kept, df)
    assert all(folder in f for f in kept.inputFiles())


def test_release_frees_staged_tables(spark):
    kept = stage(spark.range(10), "gone")
    before = kept.inputFiles()
    assert release(spark) >= 1
    assert release(spark) == 0
    assert not any(os.path.exists(f.removeprefix("file://")) for f in before)


def test_shuffle_partitions_follow_the_input():
    assert partitions_for(10**9) == 200
    assert partitions_for(10**12) == 3726
    assert partitions_for(100 * 10**12) == 50_000


def test_a_null_month_is_refused(spark, tmp_path):
    table = tables.create_feature_table(str(tmp_path / "t"), "zip", "at", rows(spark, (1, 1, 10)))
    bad = spark.createDataFrame([(9, None, None, 1)], ROWS)
    with pytest.raises(ValueError):
        tables.upsert_feature_table(table, bad)
    with pytest.raises(ValueError):
        tables.create_feature_table(str(tmp_path / "u"), "zip", "at", bad)
    assert stored(table, spark) == [(1, "2024-01", 10)]
