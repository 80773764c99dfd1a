"""Plain ``datetime`` arguments are UTC wherever the driver runs."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from datetime import datetime
from pyspark.sql import SparkSession, functions as F
from tidegauge.operators import reports, rollups, timeline
from tidegauge.functions.times import instant
spark = (SparkSession.builder.master("local[1]").config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate())
df = spark.range(600).selectExpr("timestamp_micros(1706400000000000 + id * 60000000) AS arrival_timestamp")
as_of = datetime(2024, 1, 28, 6, 30)
for value in (as_of, "2024-01-28 06:30:00"):
    print("ROWS", timeline.filter_last(df, 60, value).count(), spark.range(1).select(F.unix_seconds(instant(value))).first()[0])
"""


def test_naive_datetimes_are_utc():
    root = Path(__file__).resolve().parents[1]
    env = {"TZ": "America/New_York", "PYTHONPATH": str(root), "PATH": "/usr/bin:/bin:" + str(Path(sys.executable).parent)}
    out = subprocess.run([sys.executable, "-c", SCRIPT], env={**os.environ, **env}, cwd=root, capture_output=True, text=True, timeout=300)
    lines = [x for x in out.stdout.splitlines() if x.startswith("ROWS")]
    assert len(lines) == 2 and lines[0] == lines[1] == "ROWS 270 1706423400", out.stdout + out.stderr[-2000:]
