"""Results must not depend on the zone of the Python process or the JVM."""

import os
import subprocess
import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.functions.arguments import naive_utc

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path[:0] = [sys.argv[1], sys.argv[1] + "/tests"]
from pyspark.sql import SparkSession
from compare import connect, difference
import __spark_entry__ as entry
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", sys.argv[3]).getOrCreate())
assert spark.conf.get("spark.sql.session.timeZone") != "UTC"
con = connect(sys.argv[2])
for name in ("incremental_load", "lookback", "insert_ignore_stock", "cagg_hourly_refresh", "ingest_range"):
    problem = difference(entry.queries()[name](spark, sys.argv[2]), con, entry.oracle_sql()[name])
    assert problem is None, (name, problem)
"""


def test_queries_in_another_zone(sf_dir, tmp_path):
    env = {**os.environ, "TZ": "Asia/Singapore"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(ROOT), sf_dir, str(tmp_path)], env=env, cwd=tmp_path,
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]


def test_moments(spark):
    naive = datetime(2024, 1, 31, 20, 0, 0, 5)
    zoned = naive.replace(tzinfo=timezone.utc).astimezone(timezone(timedelta(hours=8)))
    assert naive_utc(zoned) == naive_utc(naive) == naive
    row = spark.range(1).select(C.utc(naive).alias("a"), C.utc(zoned).alias("b"))
    assert row.select(F.date_format("a", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("a") == F.col("b")).first() == (
        "2024-01-31 20:00:00.000005", True)
    assert C.moment_of(row, F.max("a")) == naive
