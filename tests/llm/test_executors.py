"""Executors need no copy of the package: a session whose workers cannot import
it runs every query with Python on its path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("adlens") is None])], ["x"])

assert spark.range(1).mapInArrow(importable, "x boolean").first()[0]  # before the driver's path changes
sys.path.insert(0, {repo!r})
from adlens.llm import decontamination, quality, simhash, resampling, secret_scan, pii
docs = spark.createDataFrame([(n, "some text of number %d " % n * 9, "s") for n in range(12)],
                             "doc_id long, text string, source string")
labels = spark.createDataFrame([(n, n % 2) for n in range(12)], "doc_id long, quality int")
bench = docs.selectExpr("doc_id AS item_id", "text").limit(3)
model = quality.fit(docs, labels)
assert quality.score_documents(docs, model).count() == 12
assert quality.score_documents(docs, model).where("score is null").count() == 0
assert decontamination.find_leaks(docs, bench).where("size(matches) > 0").count() >= 3
assert simhash.link_documents(docs).where("fingerprint is null").count() == 0
assert resampling.resample(docs, bench.select("text")).where("score is null").count() == 0
assert secret_scan.find_secrets(docs).where("spans is null").count() == 0
assert pii.find_pii(docs).where("spans is null").count() == 0
print("all ran")
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "all ran" in got.stdout, got.stderr[-3000:]
