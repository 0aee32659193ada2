"""Windows of a stream with every row accounted for."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import drift as D
from tidegauge.streaming.ledger import START, Rollup, WindowMonitor

T0 = datetime(2024, 3, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "at timestamp, v double, w double")


@pytest.fixture(scope="module")
def batches():
    rng = random.Random(2)
    made = []
    for b in range(4):
        rows = []
        for _ in range(60):
            at = T0 + timedelta(minutes=b * 180 + rng.randint(-400, 170))
            rows.append((at if rng.random() < 0.95 else None, rng.choice([None, float("nan"), rng.random(), 3.0]), rng.random()))
        made.append(rows)
    made.insert(2, [])
    return made


def by_hand(batches, lateness=timedelta(hours=2)):
    windows, late, mark = {}, {}, None
    for rows in batches:
        for at, v, w in rows:
            start = at and at.replace(minute=0)
            if start is None or (mark is not None and start + timedelta(hours=1) <= mark):
                late[start] = late.get(start, 0) + 1
                continue
            windows.setdefault(start, []).append((v if v == v else None, w))
        seen = [at for at, _, _ in rows if at]
        if seen:
            mark = max([max(seen) - lateness, *([mark] if mark else [])])
    return windows, late, mark


def test_rows_are_in_windows_or_late(spark, batches, tmp_path):
    hours = Rollup.of(str(tmp_path), "at", sums=["v"], means=["w"])
    assert hours.ledger.watermark(spark, 0) is None
    for i, rows in enumerate(batches):
        hours.ledger.take(frame(spark, rows), i)
        if i == 3:
            # A batch that is run again leaves one copy of its rows.
            hours.ledger.take(frame(spark, rows), i)
    windows, late, mark = by_hand(batches)
    assert {r[START]: r["n_late"] for r in hours.ledger.late(spark).collect()} == late
    every = {r[START]: r for r in hours.windows(spark, flush=True).collect()}
    assert {k: r["n"] for k, r in every.items()} == {k: len(v) for k, v in windows.items()}
    assert sum(r["n"] for r in every.values()) + sum(late.values()) == sum(map(len, batches)) and late
    for start, rows in windows.items():
        known = [v for v, _ in rows if v is not None]
        assert every[start]["w"] == pytest.approx(sum(w for _, w in rows) / len(rows))
        assert every[start]["v"] == (pytest.approx(sum(known)) if known else None)
    final = {r[START] for r in hours.windows(spark).collect()}
    assert final == {s for s in windows if s + timedelta(hours=1) <= mark} and len(final) < len(windows)


def test_verdicts_do_not_depend_on_batches(spark, batches, tmp_path):
    rows = [r for part in batches for r in part]
    profile = D.build_profile(frame(spark, [(T0, i / 100, i / 100) for i in range(100)]), ["v", "w"])
    found = []
    for name, pieces in (("one", [rows]), ("many", [rows[i::7] for i in range(7)])):
        days = WindowMonitor.of(str(tmp_path / name), profile, "at", window="6 hours", lateness="30 days")
        for i, piece in enumerate(pieces):
            days.ledger.take(frame(spark, piece), i)
        found.append(sorted(map(tuple, days.verdicts(spark, flush=True).collect()), key=repr))
    assert found[0] == found[1] and found[0]
    timed = frame(spark, [r for r in rows if r[0]]).withColumn(START, F.window("at", "6 hours")["start"])
    direct = {(r[START], r["column"]): (r["psi"], r["n_current"], r["n_outside"]) for r in D.psi_against(profile, timed, [START]).collect()}
    assert {(r[0], r[1]): (r[2], r[4], r[5]) for r in found[0]} == direct
