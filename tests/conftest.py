from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tidegauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, app="tests", memory="4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


def column(df, name):
    return [r[name] for r in df.select(f"`{name}`").collect()]


@pytest.fixture(scope="session")
def readings(spark):
    """Four clean readings with a second energy column."""
    rows = [
        ("Weekday", "Monday", "light", 1.0, 0.1, 10.0, 0.9, 0.1, 100.0, "2024-01-01 05:00:00", 10.0),
        ("Weekend", "Sunday", "medium", 2.0, 0.2, 11.0, 0.85, 0.2, 200.0, "2024-01-02 06:00:00", 20.0),
        ("Weekday", "Tuesday", "light", 1.5, 0.3, 12.0, 0.95, 0.15, 150.0, "2024-01-03 07:00:00", 15.0),
        ("Weekend", "Sunday", "heavy", 2.5, 0.4, 13.0, 0.8, 0.1, 250.0, "2024-01-04 08:00:00", 18.0),
    ]
    names = [
        "weekstatus",
        "day_of_week",
        "load_type",
        "lagging_current_reactive.power_kvarh",
        "leading_current_reactive_power_kvarh",
        "co2(tco2)",
        "lagging_current_power_factor",
        "leading_current_power_factor",
        "nsm",
        "date",
        "usage_kwh",
    ]
    df = spark.createDataFrame(rows, names)
    return df.withColumn("date", df["date"].cast("timestamp_ntz"))
