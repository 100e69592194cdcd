"""What replays and their state may cost as the tables grow."""

from __future__ import annotations

import uuid
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from pulse.streaming.continuity import _FIELDS, SLICES_TOGETHER, StockLevels
from testkit.replay import replay_files, replayed


class Calls:
    """Stands for the handle and its state variables, and counts the calls that cross to the JVM."""

    def __init__(self):
        self.n, self.timers = 0, set()

    def getMapState(self, *_):
        return Stored(self)

    def getValueState(self, *_):
        return Stored(self)

    def registerTimer(self, at):
        self.n += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.n += 1
        self.timers.remove(at)


class Stored:
    def __init__(self, calls):
        self.calls, self.kept = calls, {}

    def __getattribute__(self, name):
        if name not in ("calls", "kept"):
            object.__getattribute__(self, "calls").n += 1
        return object.__getattribute__(self, name)

    def keys(self):
        return iter(list(self.kept))

    def exists(self):
        return None in self.kept

    def get(self):
        return self.kept.get(None)

    def update(self, value):
        self.kept[None] = value

    def clear(self):
        self.kept.pop(None, None)

    def containsKey(self, key):
        return key in self.kept

    def getValue(self, key):
        return self.kept.get(key)

    def updateValue(self, key, value):
        self.kept[key] = value

    def removeKey(self, key):
        del self.kept[key]


def test_calls_to_the_state_follow_stretches_and_not_slices():
    calls, levels, slices = Calls(), StockLevels(1000), 20 * SLICES_TOGETHER
    levels.init(calls)
    moves = pd.DataFrame([(s * 1_000_000, f"{s:06d}", "w", 1, s) for s in reversed(range(slices))], columns=_FIELDS)
    found = []

    def watermark(ms):
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
        for at in sorted(t for t in calls.timers if t <= ms):
            found.extend(row for frame in levels.handleExpiredTimer(("p",), times, None) for row in frame.itertuples(index=False, name=None))
            calls.timers.discard(at)

    list(levels.handleInputRows(("p",), iter([moves]), None))
    watermark((slices - 90) * 1000)  # in the middle of a stretch
    assert len(found) == slices - 90
    watermark(slices * 1000)
    assert [row[2] for row in found] == sorted(moves["event_id"])
    assert [None if row[6] is pd.NA else row[6] for row in found] == [None, *range(slices - 1)]
    assert not calls.timers and calls.n < slices


def test_a_part_of_a_replay_is_many_files_and_one_micro_batch(spark, tmp_path):
    sizes = {0: 1, 1: 950, 3: 400}  # part 2 is empty
    rows = spark.range(sum(sizes.values())).select("id", F.when(F.col("id") < 1, 0).when(F.col("id") < 951, 1).otherwise(3).alias("__part"))
    strays = rows.limit(3).withColumn("__part", F.lit(None).cast("int")).unionByName(rows.limit(2).withColumn("__part", F.lit(9)))
    files = replay_files(rows.unionByName(strays), 4, f"{tmp_path}/replay", rows_per_file=100)
    assert files == 10
    seen, name = [], f"replayed_{uuid.uuid4().hex}"

    def write(batch, batch_id):
        found = batch.agg(F.count("id"), F.min("id"), F.max("id")).first()
        seen.append((batch_id, *found, batch.rdd.getNumPartitions()))

    (replayed(spark, f"{tmp_path}/replay", "id bigint", files).writeStream.queryName(name).trigger(availableNow=True)
     .option("checkpointLocation", f"{tmp_path}/c").foreachBatch(write).start().awaitTermination())
    assert [row[:4] for row in seen] == [(0, 1, 0, 0), (1, 950, 1, 950), (2, 0, None, None), (3, 400, 951, 1350)]
    assert seen[1][4] > 1
