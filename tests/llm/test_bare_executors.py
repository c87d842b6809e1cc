"""Workers that cannot import the package run every operator."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
     .config("spark.sql.session.timeZone", "UTC").getOrCreate())
s.sparkContext.setLogLevel("OFF")

def probe(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("textloom") is None] * b.num_rows)], ["bare"])
assert s.range(1).mapInArrow(probe, "bare boolean").first()[0], "workers see the package"
from textloom.checks import QUERIES as OWN
from textloom.llm.queries import QUERIES
names = [*QUERIES.items(), *((k, OWN[k]) for k in ("encode_fixed_length", "assign_batches_ordered", "evaluate"))]
for key, query in names:
    query(s, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", key)
"""


def test_every_operator_runs_without_the_package_on_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout[-600:] + done.stderr[-3000:]
    assert done.stdout.count("ran ") == 16
