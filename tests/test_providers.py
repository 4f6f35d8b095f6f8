"""Asynchronous endpoints, encoders and detectors, against fakes."""

import asyncio
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.sources import detectors, providers

ANSWER = T.StructType([T.StructField("answer", T.StringType()), T.StructField("started", T.DoubleType()), T.StructField("ended", T.DoubleType()), T.StructField("open", T.LongType())])


class Slow:
    """Answers after a while; some rows fail, some never answer."""

    def __init__(self, endpoint):
        self.endpoint, self.open, self.failed = endpoint, 0, set()
        asyncio.get_running_loop()  # made inside the loop

    async def process_one(self, row):
        self.open += 1
        try:
            began, most = time.time(), self.open
            await asyncio.sleep(30 if row["id"] == 13 else 0.05 + 0.01 * (row["id"] % 3))
            if row["id"] % 10 == 7 or (row["id"] % 10 == 8 and row["id"] not in self.failed):
                self.failed.add(row["id"])
                raise RuntimeError(f"bad row {row['id']}")
            return {"answer": f"{self.endpoint}:{row['id']}", "started": began, "ended": time.time(), "open": most}
        finally:
            self.open -= 1


def test_async_requests_overlap_in_order(spark):
    n = 240
    rows = spark.range(n).select("id", (F.col("id") % 50 != 11).cast("long").alias("frame_ok"), F.lit("no frames").alias("frame_error"), F.lit("old").alias("answer"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        out = providers.apply_async_provider(rows, Slow, ANSWER, "camera", ["a", "b"], concurrency=8, timeout_sec=0.4, retries=1, needs=("frame_ok", "frame_error"))
        got = out.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()).orderBy("place").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.id for r in got) == list(range(n)) and {r.part for r in got} == {0, 1}
    for r in got:
        if r.id % 50 == 11:
            assert (r.camera_ok, r.camera_error, r.answer) == (0, "no frames", None)
        elif r.id == 13:
            assert (r.camera_ok, r.camera_error) == (0, "no answer within 0.4 s")
        elif r.id % 10 == 7:
            assert (r.camera_ok, r.camera_error) == (0, f"bad row {r.id}")
        else:  # rows that end with 8 succeed when they are sent again
            assert (r.camera_ok, r.camera_error, r.answer) == (1, "", f"{'ab'[r.part]}:{r.id}")
    for part in (0, 1):
        done = [r for r in got if r.part == part and r.camera_ok == 1]
        assert 4 < max(r.open for r in done) <= 8  # requests overlap, and no more than allowed
        spent = sum(r.ended - r.started for r in done)
        assert max(r.ended for r in done) - min(r.started for r in done) < spent / 3
    # rows keep their order, whichever answer comes first
    one = providers.apply_async_provider(spark.range(0, 60, 1, 1), Slow, ANSWER, "camera", ["a"], concurrency=8, timeout_sec=0.2)
    assert [r.id for r in one.withColumn("place", F.monotonically_increasing_id()).orderBy("place").collect()] == list(range(60))


def test_async_provider_refuses_nonsense(spark):
    for more in ({"endpoints": []}, {"endpoints": ["a"], "concurrency": 0}, {"endpoints": ["a"], "retries": -1}):
        with pytest.raises(ValueError):
            providers.apply_async_provider(spark.range(1), Slow, ANSWER, "x", **more)
    assert providers.apply_async_provider(spark.range(0), Slow, ANSWER, "x", ["a"]).count() == 0


class Fake:
    size_multiple = 16

    def encode_batch(self, frames, width, height, rows):
        if any(r["id"] % 9 == 4 for r in rows):
            raise RuntimeError("unreadable")
        return [{"latent": f"{frames}x{height}x{width}", "size": len(rows)} for _ in rows]


def test_encoder_gets_batches_of_one_bucket(spark):
    rows = spark.range(60).select("id", F.lit(17).alias("frames"), F.when(F.col("id") % 2 == 0, 832).otherwise(480).alias("w"), F.when(F.col("id") == 5, 481).when(F.col("id") == 6, None).otherwise(480).alias("h")).repartition(3)
    fields = T.StructType([T.StructField("latent", T.StringType()), T.StructField("size", T.LongType())])
    for r in providers.apply_encoder(rows, Fake, fields, "encode", ("frames", "w", "h"), batch=4).collect():
        if r.id in (5, 6):
            assert r.encode_ok == 0 and r.encode_error.startswith("no size of the encoder: 17 frames of")
        elif r.id % 9 == 4:
            assert (r.encode_ok, r.encode_error, r.latent) == (0, "unreadable", None)
        else:
            assert r.encode_ok == 1 and r.latent == f"17x480x{832 if r.id % 2 == 0 else 480}" and 1 <= r.size <= 4


def test_detectors_alone_and_together(spark):
    rows = spark.createDataFrame(
        [("a", 10.0, [2.0, 2.0000004, 12.0], 1, "", [5.0]), ("b", 3.0, None, 0, "broken", [1.0]), ("c", 4.0, [], 1, "", None)],
        "video_id string, duration_sec double, hard array<double>, hard_ok int, hard_error string, soft array<double>",
    )
    known = {"hard": detectors.from_column("hard", "hard_ok", "hard_error"), "soft": detectors.from_column("soft"), "even": detectors.uniform(4.0), "drawn": detectors.drawn(2.0, 2, 0.5, 7)}
    got = {r.video_id: (r.ticks_sec, r.detectors, r.detect_ok, r.detect_error) for r in detectors.detect(rows, known, ["hard", "soft"]).collect()}
    both = ["hard", "soft"]
    assert got == {"a": ([0.0, 2.0, 5.0, 10.0], both, 1, ""), "b": ([], both, 0, "hard: broken"), "c": ([], both, 0, "soft: no cut points")}
    even = {r.video_id: r.ticks_sec for r in detectors.detect(rows, known, ["even"]).collect()}
    assert even == {"a": [0.0, 4.0, 8.0], "b": [], "c": [0.0, 4.0]}
    one, two = ({r.video_id: r.ticks_sec for r in detectors.detect(rows, known, ["drawn"]).collect()} for _ in range(2))
    assert one == two and all(0 <= t <= 10 for t in one["a"]) and len(one["a"]) >= 2
    for names in ([], ["hard", "hard"], ["none"], ["even", "hard"]):
        with pytest.raises(ValueError):
            detectors.detect(rows, known, names)
