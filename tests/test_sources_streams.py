"""Streams with state, tar files as a source, counts while writing and from footers, table functions, linear folds."""

import io
import random
import tarfile
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.operators import fanout, timeline
from siftwell.sources import shards, tars
from siftwell.streaming import incremental


def test_last_success_over_micro_batches(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, seen = str(tmp_path / "in"), []
    schema = "clip string, ts timestamp, ok long, note string"

    def add(*rows):
        spark.createDataFrame([(k, m, ok, n) for k, m, ok, n in rows], "clip string, m long, ok long, note string").select("clip", F.timestamp_micros(F.col("m") * 1_000_000).alias("ts"), "ok", "note").coalesce(1).write.mode("append").parquet(source)

    def run():
        seen.clear()
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        out = incremental.last_success(stream, "clip", "ts", "ok", "60 seconds", 100_000)
        query = out.writeStream.outputMode("update").foreachBatch(lambda b, _: seen.extend((r.clip, r.note) for r in b.collect())).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(seen)

    try:
        add(("a", 100, 1, "a100"), ("a", 120, 0, "failed"), ("b", 100, 0, "failed"), ("c", 100, 1, "c100"), ("c", 100, 1, "c100 again"), ("c", None, 1, "no time"))
        assert run() == [("a", "a100"), ("c", "c100 again")]
        # a restart goes on from the checkpoint: a later success replaces, an earlier one that comes late does not
        add(("a", 110, 1, "a110"), ("b", 115, 1, "b115"), ("c", 99, 1, "c99"), ("c", 130, 0, "failed"))
        assert run() == [("a", "a110"), ("b", "b115")]
        add(("a", 105, 1, "a105"), ("c", 131, 1, "c131"))
        assert run() == [("c", "c131")]
        # far beyond the idle time the state of a is gone, so an earlier time than before is a first success again
        add(("z", 1000, 1, "z"))
        run()
        add(("z", 1001, 1, "z1"))
        run()
        add(("a", 995, 1, "a995"), ("z", 990, 1, "z990"))
        assert run() == [("a", "a995")]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def tar_file(path, names):
    with tarfile.open(path, "w") as t:
        for n in names:
            info = tarfile.TarInfo(n)
            if n.endswith("/"):
                info.type = tarfile.DIRTYPE
                t.addfile(info)
            else:
                data = n.encode() * 3
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))


def test_tar_members_as_a_source(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    tar_file(tmp_path / "a.tar", ["x/1.mp4", "x/2.MP4", "x/3.txt", "../up.mp4", "/abs.mp4", "dir/"])
    tar_file(tmp_path / "sub" / "b.tar", [f"y/{i}.mp4" for i in range(25)])
    tar_file(tmp_path / "c.txt", ["no.mp4"])
    tars.register(spark)
    df = spark.read.format("tar_members").option("suffixes", ".mp4,.mkv").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 2  # one task a file
    got = df.orderBy("member").collect()
    assert [r.member for r in got] == sorted(["x/1.mp4", "x/2.MP4", *[f"y/{i}.mp4" for i in range(25)]])
    for r in got:
        with open(r.path, "rb") as f:  # offsets are those of the contents
            f.seek(r.offset)
            assert f.read(r.size) == r.member.encode() * 3
    one = spark.read.format("tar_members").load(str(tmp_path)).where(F.col("path") == str(tmp_path / "a.tar"))
    assert one.rdd.getNumPartitions() == 1 and one.count() == 3
    ends = spark.read.format("tar_members").load(str(tmp_path)).where(F.col("member").endswith(".txt") | F.col("member").startswith("none"))
    assert [r.member for r in ends.collect()] == ["x/3.txt"]
    ends = spark.read.format("tar_members").load(str(tmp_path)).where(F.col("member").endswith("4.mp4"))
    assert sorted(r.member for r in ends.collect()) == ["y/14.mp4", "y/24.mp4", "y/4.mp4"]
    # the reader itself takes such conditions
    reader = tars.TarMembersReader({"path": str(tmp_path)})
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringEndsWith

    left = list(reader.pushFilters([StringEndsWith(("member",), ".txt"), EqualTo(("path",), "none"), GreaterThan(("size",), 1)]))
    assert left == [GreaterThan(("size",), 1)] and reader.partitions() == []


def test_counts_come_from_the_write_itself(spark, tmp_path):
    touched = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            touched.add(b.num_rows)
            yield b

    df = spark.range(1000).selectExpr("id", "case when id % 10 = 0 then null when id % 3 = 0 then 1 else 0 end as ok").mapInArrow(look, "id long, ok int")
    path = str(tmp_path / "out")
    counts = shards.write_pass_reject(df, path, "clip", "ok")
    assert counts == {"output_count": 1000, "pass_count": 300, "reject_count": 700} == shards.read_summary(spark, path)
    assert touched.value == 1000  # the rows were made once
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ok", T.IntegerType())])
    for name, n in (("", 1000), ("/pass", 300), ("/reject", 700)):
        assert shards.count_unit(spark, path + name, "clip", schema) == n == shards.read_unit(spark, path + name, "clip", schema).count()
    assert shards.write_unit(df.limit(0), str(tmp_path / "none"), "clip", counts={"top": F.max("id")}) == {"rows": 0, "top": None}


def test_footers_answer_counts_and_bounds(spark, tmp_path):
    path = str(tmp_path / "u")
    shards.write_unit(spark.range(1000).selectExpr("id", "id / 4 as x", "string(id) as s"), path, "clip", rows_per_shard=300)
    spark.range(50).write.parquet(path + "/other-0.parquet")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])
    stats = shards.footer_stats(spark, path, "clip", schema, ["id", "x"])
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(x), MAX(x)]" in plan
    assert tuple(stats.first()) == (1000, 0, 999, 0.0, 249.75)
    assert shards.count_unit(spark, path, "clip", schema) == 1000 and shards.count_unit(spark, path, "clip", schema, limit=7) == 7
    assert shards.count_unit(spark, path, "clip", schema, where=F.col("id") < 10) == 10
    assert shards.count_unit(spark, str(tmp_path / "absent"), "clip", schema) == 0
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the user's session is as it was


def ranges_by_hand(rows):
    out, by_id = set(), {}
    for i, t in rows:
        if i is not None and t is not None and t == t:
            by_id.setdefault(i, []).append(round(t, 6))
    for i, ticks in by_id.items():
        kept = []
        for t in sorted(ticks):
            if not kept or t - kept[-1] > timeline.EPS:
                kept.append(t)
        out |= {(i, k, a, b) for k, (a, b) in enumerate(zip(kept, kept[1:]))}
    return out


def ticks_of(seed, dense):
    r = random.Random(seed)
    rows = [(f"v{r.randint(0, 6)}", r.choice([r.uniform(0, 50), r.randint(0, 40) / 4])) for _ in range(400)]
    rows += [("hot", k * 1e-6 if dense else k / 8 + r.choice([0, 1e-6, 2e-6])) for k in range(700)]
    return rows + [("one", 1.0), (None, 2.0), ("gap", None), ("gap", float("nan")), ("gap", 3.0), ("gap", 4.0)]


@pytest.mark.parametrize("seed, dense", [(1, False), (2, True), (3, False)])
def test_linear_fold_over_ranges(spark, seed, dense):
    rows = ticks_of(seed, dense)
    df = spark.createDataFrame(rows, "video string, tick double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many ranges, so that ids are spread over them
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        out = fanout.fold_ticks(df, "video", "tick").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(out) == len(set(out)) and {tuple(r) for r in out} == ranges_by_hand(rows)
    assert fanout.fold_ticks(df.limit(0), "video", "tick").count() == 0


def test_a_million_ticks_of_one_id(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("id"), (F.col("id") * 0.5).alias("t"))
    out = fanout.fold_ticks(df, "id", "t").agg(F.count("*"), F.max("range_index"), F.sum(F.col("end_sec") - F.col("start_sec")), F.count_if(F.col("start_sec") != F.col("range_index") * 0.5)).first()
    assert tuple(out) == (999_999, 999_998, 499_999.5, 0)


def test_table_function_of_ranges(spark):
    rows = ticks_of(5, False)
    name = "t" + uuid.uuid4().hex
    spark.createDataFrame(rows, "video string, tick double").where("video is not null and not isnan(tick)").createOrReplaceTempView(name)
    fanout.register(spark)
    out = spark.sql(f"SELECT * FROM tick_ranges(TABLE(SELECT video, tick FROM {name}))")
    assert out.columns == ["video", "range_index", "start_sec", "end_sec"]
    assert {tuple(r) for r in out.collect()} == ranges_by_hand(rows)
