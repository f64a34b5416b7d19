"""Python workers have to get by without this package on their path."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from docflow.plans.queries import QUERIES
from docflow.sources.objects import store_fetcher
from docflow.sources.sinks import put_objects

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("extract_text_python", "previews_rendered_python"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
rows = spark.createDataFrame([("b", "k", "text")], "Bucket string, output_key string, text string")
assert put_objects(rows, sys.argv[2], "text").count() == 1
sent = spark.createDataFrame([("u", "b", "k")], "uid string, Bucket string, Key string")
assert bytes(store_fetcher(sys.argv[2], 1)(sent).first().content) == b"text"
print("all done")
"""


def test_from_another_folder(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT), (tmp_path / "store").as_uri()],
        cwd=tmp_path,
        capture_output=True,
        text=True,
        timeout=180,
    )
    assert "all done" in done.stdout, done.stderr[-2000:]
