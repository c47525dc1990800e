"""Silent zones on the stream: alerts as windows close."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest

from tests.test_streaming import START, Feed, reading
from wattledger.streaming import changes, closing, queries


class Watched(Feed):
    """A feed whose zone query knows the zones Z1 and Z2."""

    def __init__(self, spark, root):
        super().__init__(spark, root)
        self.dim = spark.createDataFrame([("Z1",), ("Z2",), ("Z1",)], "grid_zone string")

    def drain(self):
        queries.start_zone_load(
            self.parsed(), f"{self.root}/zone", f"{self.root}/alerts", f"{self.root}/cp", None, zones=self.dim
        ).awaitTermination()
        return self.silent()

    def log(self):
        root = f"{self.root}/alerts"
        schema = self.spark.read.parquet(f"{root}/changes").drop("batch_id").schema
        return changes.read_changes(self.spark, root, schema).filter("alert_type = 'ZONE_SILENT'")

    def silent(self):
        return sorted((r.entity_id, hours(r.window_start)) for r in self.log().collect())


def hours(at: datetime) -> float:
    return (at - START) / timedelta(hours=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Watched(spark, str(tmp_path))


def test_a_zone_silent_for_a_day_raises_once_a_window(feed):
    """Z2 stops after two hours, for a day; rows come in several batches and runs."""
    got = []
    for part in range(4):
        minutes = range(part * 420, (part + 1) * 420, 30)
        feed.land([reading(m, m, zone="Z1") for m in minutes])
        feed.land([reading(10_000 + m, m, zone="Z2", household="h2") for m in minutes if m < 120 or m >= 1560])
        got.append(feed.drain())
    assert got[-1] == [("Z2", h) for h in range(2, 26)]
    assert all(set(a) <= set(b) for a, b in zip(got, got[1:], strict=False))
    assert max(Counter((r.entity_id, r.window_start) for r in feed.log().collect()).values()) == 1
    row = feed.log().first()
    assert (row.severity, row.metric_value, row.threshold) == ("CRITICAL", 0, 1)


def test_open_windows_raise_nothing_and_late_readings_count(feed):
    feed.land([reading(1, 10), reading(2, 10, zone="Z2"), reading(3, 70), reading(4, 134)])
    assert feed.drain() == []  # the second window is open for another minute
    feed.land([reading(5, 115, zone="Z2")])  # late, but in time
    feed.land([reading(6, 190)])
    assert feed.drain() == []
    feed.land([reading(7, 300)])
    assert feed.drain() == [("Z2", 2.0), ("Z2", 3.0)]


def test_all_zones_silent_between_two_readings(feed):
    feed.land([reading(1, 10), reading(2, 10, zone="Z2")])
    feed.drain()
    feed.land([reading(3, 190), reading(4, 250)])
    assert feed.drain() == [("Z1", 1.0), ("Z1", 2.0), ("Z2", 1.0), ("Z2", 2.0)]


def test_nothing_valid_closes_nothing(feed):
    feed.land(["not json"])
    feed.land([reading(1, 10)])
    assert feed.drain() == []


def test_a_replayed_batch_closes_the_same(spark, feed):
    for minute in (10, 130, 400):
        feed.land([reading(minute, minute)])
        feed.drain()
    before = feed.silent()
    progress = f"{feed.root}/zone/progress"
    rows = lambda: sorted(map(tuple, spark.read.parquet(progress).collect()), key=repr)
    known = rows()
    last = max(r[-1] for r in known)
    log = spark.read.parquet(f"{feed.root}/zone/changes").drop("batch_id")
    for batch in range(1, last + 1):
        path = f"{feed.root}/zone/changes/batch_id={batch}"
        stored = spark.read.schema(log.schema).parquet(path)
        first = closing.advance(stored, f"{feed.root}/zone", batch)
        assert first == closing.advance(stored, f"{feed.root}/zone", batch)
    assert rows() == known and feed.silent() == before


def test_ends_of_a_batch(spark):
    at = lambda h: START + timedelta(hours=h)
    ends = lambda *a, **k: tuple(closing.Closing(*a).ends(spark, **k).first())
    assert ends(None, None, None) == (None, None)
    assert ends(at(0), None, None) == (None, None)
    assert ends(at(0), None, at(0.9)) == (None, None)
    assert ends(at(0), None, at(1)) == (at(0), at(0))
    assert ends(at(0), at(1), at(1)) == (None, None)
    assert ends(at(0), at(1), at(3.5)) == (at(1), at(2))
    assert ends(at(2), at(1), at(3.5)) == (at(2), at(2))
    assert ends(at(0), at(0.6), at(1.3), width="30 minutes") == (at(0.5), at(0.5))
