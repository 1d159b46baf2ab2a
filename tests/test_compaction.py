"""Small files of a stream are packed, and each line is read once at any point."""

import glob
import os
import tempfile

import pytest
from test_streaming import message, topic

from tillhouse.sources.manifests import PartTable
from tillhouse.streaming import compaction, live
from tillhouse.streaming.compaction import DailyFiles

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def triggers(n, first=0):
    """Each trigger holds a line of every day and one without a day."""
    lines = [[message(f"T{k}-{d}", "A", f"{d} 10:00:00") for d in DAYS] for k in range(first, first + n)]
    return [[*rows, '{"transaction_id": "N%d", "product_id": "A"}' % k] for k, rows in enumerate(lines, first)]


class Feed:
    def __init__(self, spark):
        self.spark, self.area, self.ids = spark, tempfile.mkdtemp(prefix="tillhouse-"), []
        self.lines = live.typed_lines(topic(spark, triggers(1)))

    def send(self, n):
        """Further triggers; the stream is started again from its checkpoint."""
        first = len(self.ids) // 4
        for rows in triggers(n, first):
            df = self.spark.createDataFrame([(r,) for r in rows], "value string").selectExpr("value", "timestamp'2024-01-01 00:00:00' as timestamp")
            df.coalesce(1).write.mode("append").parquet(f"{self.area}/topic")
            self.ids += [f"T{first}-{d}" for d in DAYS] + [f"N{first}"]
            first += 1
        stream = live.typed_lines(live.file_messages(self.spark, f"{self.area}/topic", files_per_trigger=1))
        live.write_daily_files(stream, f"{self.area}/days", f"{self.area}/checkpoint", available_now=True).awaitTermination()

    def files(self):
        return DailyFiles(self.spark, f"{self.area}/days", f"{self.area}/packed", self.lines.schema)

    def whole(self):
        rows = self.files().read().select("transaction_id", "date", "file_day").collect()
        assert all(r["date"] == r["file_day"] for r in rows)
        return sorted(r["transaction_id"] for r in rows) == sorted(self.ids)

    def on_disk(self, folder, closed_only=True):
        found = glob.glob(f"{self.area}/{folder}/**/*.parquet", recursive=True)
        return [f for f in found if "_spark_metadata" not in f and not (closed_only and DAYS[-1] in f)]


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_packed_lines_are_read_once(feed):
    assert feed.files().read().count() == 0 and feed.files().pack() == 0  # nothing written yet
    feed.send(5)
    assert feed.whole() and len(feed.on_disk("days")) == 15
    assert feed.files().pack() == 15 and feed.files().pack() == 0
    assert feed.whole() and len(feed.on_disk("packed/parts")) == 3
    assert len(feed.files().loose()) == 5  # the newest day stays open
    assert len(set(feed.files().read().inputFiles())) == 3 + 5


def test_late_lines_restarts_and_deletion(feed):
    for turn in range(compaction.PACKS + 3):
        feed.send(1)
        assert feed.whole()
        assert feed.files().pack() == 3 and feed.whole()
        assert len(feed.on_disk("days")) <= 2 * 3  # files are deleted once two manifests hold their lines
        parts = [p for p, _ in feed.files().table.manifest().parts]
        assert max(parts.count(p) for p in parts) <= compaction.PACKS
    assert len(os.listdir(f"{feed.area}/packed/consumed")) == 2


@pytest.mark.parametrize("dies_at", ["_publish", "commit", "_clean"])
def test_a_crash_loses_and_repeats_nothing(feed, monkeypatch, dies_at):
    feed.send(2)
    feed.files().pack()
    feed.send(2)
    with monkeypatch.context() as patch:
        def fail(*_):
            raise RuntimeError("lost")

        patch.setattr(PartTable, dies_at, fail)
        with pytest.raises(RuntimeError):
            feed.files().pack()
    assert feed.whole()
    feed.send(1)
    feed.files().pack()
    assert feed.whole() and feed.files().pack() == 0
