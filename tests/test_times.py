"""Calendar times at gaps and folds, durations, ends, and publication dates by rule."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from mereweave.functions import times as t


def show(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@pytest.mark.parametrize(
    ("stamp", "zone", "want"),
    [
        ("20240310", None, "2024-03-10 00:00:00"), ("20240310T023000", None, "2024-03-10 09:30:00"), ("20241103T013000", None, "2024-11-03 09:30:00"), ("20241103T003000", None, "2024-11-03 07:30:00"), ("20240101T120000", None, "2024-01-01 20:00:00"),
        ("20240701T120000", None, "2024-07-01 19:00:00"), ("20240310T023000Z", None, "2024-03-10 02:30:00"), ("20240331T023000", "Europe/Berlin", "2024-03-31 01:30:00"), ("20241027T023000", "Europe/Berlin", "2024-10-27 00:30:00"),
        ("2024-03-10", None, None), ("20241340T000000", None, None), (None, None, None), ("", None, None),
    ],
)
def test_calendar_instants(spark, stamp, zone, want):
    df = spark.createDataFrame([(stamp, zone)], "s string, z string")
    assert df.select(show(t.calendar_instant(F.col("s"), F.col("z")))).first()[0] == want


def test_a_zone_of_half_hours_and_every_hour_of_two_years(spark):
    """Floating times against the zone's own rules: summer time in a gap, winter time in a fold."""
    zone = ZoneInfo("Australia/Lord_Howe")
    walls = [datetime(2023, 1, 1) + timedelta(minutes=30 * k) for k in range(2 * 365 * 48)]
    want = {}
    for w in walls:
        one, two = (w.replace(tzinfo=zone, fold=f).astimezone(timezone.utc) for f in (0, 1))
        want[w.strftime("%Y%m%dT%H%M%S")] = max(one, two).strftime("%Y-%m-%d %H:%M:%S") if one < two else min(one, two).strftime("%Y-%m-%d %H:%M:%S")
    df = spark.createDataFrame([(s,) for s in want], "s string")
    got = {r[0]: r[1] for r in df.select("s", show(t.calendar_instant(F.col("s"), default="Australia/Lord_Howe"))).collect()}
    assert got == want


@pytest.mark.parametrize(("text", "want"), [("P1DT2H30M", 95_400), ("-P1W", -604_800), ("PT5S", 5), ("P1W2DT3M", 604_800 + 172_800 + 180), ("P", None), ("PT", None), ("1D", None), (None, None), ("PT1H5S", 3605)])
def test_durations(spark, text, want):
    assert spark.createDataFrame([(text,)], "s string").select(t.duration_seconds(F.col("s"))).first()[0] == want


@pytest.mark.parametrize(("start", "end", "duration", "want"), [("20240101", "20240103", None, "2024-01-02 23:59:59"), ("20240101", None, None, "2024-01-01 23:59:59"), ("20240101T000000Z", None, None, "2024-01-01 01:00:00"), ("20240101T000000Z", None, "PT90M", "2024-01-01 01:30:00"), ("20240101T000000Z", "20240101T020000Z", "PT90M", "2024-01-01 02:00:00"), ("20240101T000000Z", None, "soon", "2024-01-01 01:00:00")])
def test_ends(spark, start, end, duration, want):
    df = spark.createDataFrame([(start, end, duration, None)], "s string, e string, d string, z string")
    c = F.col
    assert df.select(show(t.calendar_end(c("s"), t.calendar_instant(c("s")), c("e"), c("z"), c("d")))).first()[0] == want


@pytest.mark.parametrize(
    ("rule", "html", "want"),
    [
        ("forum", "<style>1 day ago</style><p>3 weeks ago, 5 mins ago</p>", ("2024-01-31 11:55:00", 0.75)), ("forum", "<p>2 days ago</p><time datetime='2020-02-03'>", ("2020-02-03 00:00:00", 0.95)), ("forum", "<p>nothing</p>", None), ("list", "May 5, 2020 and June 6, 2021", ("2020-05-05 00:00:00", 0.8)),
        ("list", "Smarch 5, 2020", None), ("publication", "May 5, 2020", None), ("docs", "<meta name=date content='2019-01-02'>Last updated", ("2024-01-31 12:00:00", 0.3)), (None, "<meta name='DC.date' content='x'><meta content='2019-01-02T03:04:05Z' name='date'>", ("2019-01-02 03:04:05", 0.8)), (None, None, None),
    ],
)
def test_publication_dates(spark, rule, html, want):
    df = spark.createDataFrame([(html, rule)], "h string, r string")
    found = df.select(t.published(F.col("h"), F.col("r"), F.lit("2024-01-31 12:00:00").cast("timestamp")).alias("f")).select(show(F.col("f.at")), "f.confidence").first()
    assert tuple(found) == (want or (None, None))
