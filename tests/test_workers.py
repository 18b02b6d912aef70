"""Python workers must not need the package: executors only get what a task carries."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
for name in ("score_ab", "boosted_stump", "knn_regress"):
    rows = entry.queries()[name](spark, {data!r}).collect()
    print(name, len(rows))
"""


def test_queries_run_from_another_folder(tmp_path, small):
    repo = str(Path(__file__).parent.parent)
    script = tmp_path / "elsewhere.py"
    script.write_text(SCRIPT.format(repo=repo, data=small))
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "knn_regress" in done.stdout, done.stderr[-2000:]
