import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_events(spark):
    """Canonical events out of short dicts; what is left out has a plain value."""
    from pyspark.sql import types as T

    from tidegauge.schema import CANONICAL

    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in CANONICAL])

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            arrival = row.get("arrival_timestamp", datetime(2024, 1, 1) + timedelta(minutes=i))
            queue = row.get("queue_duration_ms", 0)
            busy = row.get("compile_duration_ms", 0) + row.get("execution_duration_ms", 1000)
            start = row.get("execution_start_time", arrival + timedelta(milliseconds=queue))
            end = row.get("execution_end_time", start + timedelta(milliseconds=busy))
            event = {
                "query_id": f"q{i}",
                "deployment_type": "provisioned",
                "instance_id": "i-1",
                "arrival_timestamp": arrival,
                "queue_duration_ms": queue,
                "compile_duration_ms": 0,
                "execution_duration_ms": 1000,
                "scanned_mb": 10.0,
                "spilled_mb": 0.0,
                "execution_start_time": start,
                "execution_end_time": end,
                "duration_seconds": (end - start).total_seconds(),
                "spill_pressure": 0.0,
                "queued": queue > 0,
                **row,
            }
            full.append(tuple(event[f.name] for f in nullable))
        return spark.createDataFrame(full, nullable)

    return make
