"""Python workers must not need the package, and a user's columns stay what they are."""

import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from fareloom.llm import quality

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {shared!r}).config("spark.sql.shuffle.partitions", "4").getOrCreate())
for name in sorted(n for n in entry.queries() if n == "pipeline" or n.startswith("op") and n[2].isdigit()):
    rows = entry.queries()[name](spark, {data!r}).collect()
    print(name, len(rows))
"""


def test_operators_run_from_another_folder(tmp_path, small):
    repo = str(Path(__file__).parent.parent.parent)
    script = tmp_path / "elsewhere.py"
    script.write_text(SCRIPT.format(repo=repo, data=small, shared=str(tmp_path / "shared")))
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=600
    )
    assert len(done.stdout.split()) == 2 * 14 and "pipeline" in done.stdout, done.stderr[-2000:]


def test_keep_good_leaves_columns_alone(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    own = docs.withColumns({"score": F.lit("mine"), "predicted": F.lit("too"), "_score": F.lit(3)})
    kept = quality.keep_good(own, labels)
    assert kept.columns == own.columns and 0 < kept.count() < docs.count()
    assert kept.select("score", "predicted", "_score").distinct().collect() == [("mine", "too", 3)]
