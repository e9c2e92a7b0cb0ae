"""Python workers must not need the package on their path."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.enabled", "false").getOrCreate())
from seriesprep import SeriesSpec
from seriesprep.models import mlp
from seriesprep.models.isolation import IsolationForest
from seriesprep.operators.ewm import ewm_mean
df = spark.range(300).select(F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts"),
                             (F.col("id") % 7).cast("double").alias("v"), (F.col("id") % 5).cast("double").alias("w"))
for layout in ("direct", "blocked"):
    assert ewm_mean(df, SeriesSpec(ts="ts", layout=layout, block_rows=50), ["v"], (6,)).count() == 300
assert IsolationForest(["v", "w"], trees=4).fit(df).transform(df).count() == 300
model = mlp.fit_mlp(df, df, ["v"], {{"w": "w"}}, mlp.Net(hidden=(4,), epochs=2))
assert model.transform(df).filter("prediction is not null").count() == 300
print("done")
"""


def test_workers_get_the_code_with_the_job(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]
