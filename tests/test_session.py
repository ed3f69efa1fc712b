"""The queries in a session that this package did not build."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "Europe/Paris").getOrCreate()
)
limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
import __spark_entry__ as contract
from compare import connect, mismatch
sf = "/root/testdata/sf0.001"
assert contract.entry(spark).count() == 10
con = connect(sf)
for name in ("feat_time", "scored_output", "timeline_5min", "history_month_slice", "stream_live_kpis"):
    assert mismatch(contract.queries()[name](spark, sf), con, contract.oracle_sql()[name]) is None, name
assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit
"""


def test_queries_run_in_a_plain_session():
    env = os.environ | {"PYTHONPATH": os.pathsep.join([str(ROOT), str(ROOT / "tests"), *filter(None, sys.path)])}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
