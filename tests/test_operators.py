"""Edge cases of the relational operators."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions import geometry, scales, text
from siftwell.operators import graph, joins, labels, profile, rules, sampling, selection, similarity, timeline
from siftwell.sources import providers, shards
from siftwell.streaming import incremental


def test_rule_order_and_nan(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 10.0), (3, float("nan")), (4, None), (5, 11.0), (6, 4.9)], "id int, v double")
    out = rules.check(df, [rules.Rule("v", "v", min=5, max=10, min_reject_reason="low", max_reject_reason="high", missing_reject_reason="none")])
    assert [r.rules_reject_reason for r in out.orderBy("id").collect()] == ["", "", "", "none", "high", "low"]


def test_rules_join_all_reasons_and_need_bounds(spark):
    df = spark.createDataFrame([(0.0, "b")], "v double, s string")
    both = [rules.Rule("v", "v", min=1, reject_reason="low"), rules.Rule("s", "s", equals="a", reject_reason="kind")]
    assert rules.check(df, both).first().rules_reject_reason == "low;kind"
    with pytest.raises(ValueError):
        rules.Rule("x", "x")
    with pytest.raises(ValueError):
        rules.Rule("x", "x", min=1)


def test_json_fields(spark):
    df = spark.createDataFrame([('{"a": {"b": 3}}',), ('{"a": {}}',), ("{bad",), (None,)], "j string")
    got = df.select(rules.resolve_field(df, "j.a.b").alias("v"), rules.json_error(df, "j").alias("e")).collect()
    assert [r.v for r in got] == [3.0, None, None, None]
    assert [r.e is not None for r in got] == [False, False, True, False]


def test_short_side_null(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 2)], "w int, h int")
    assert [r[0] for r in df.select(rules.short_side(F.col("w"), F.col("h"))).collect()] == [None, None, 2]


@pytest.mark.parametrize("bad", [(1, 1, 2, 3), (0, 2, 1, 3), (0, 1, 2, math.inf)])
def test_scale_bounds(bad):
    with pytest.raises(ValueError):
        scales.trapezoid_scale(F.lit(1.0), *bad)


def test_frame_rate(spark):
    df = spark.createDataFrame([("30000/1001",), ("25",), ("0/0",), ("x",), ("-1/2",), (None,)], "s string")
    got = [r[0] for r in df.select(F.round(scales.frame_rate(F.col("s")), 3)).collect()]
    assert got == [29.97, 25.0, None, None, None, None]


def test_ticks_fold(spark):
    chain = [0.0, 0.9e-6, 1.8e-6, 2.7e-6, 5.0]
    df = spark.createDataFrame([(1, chain), (2, []), (3, [4.0]), (4, [3.0, 1.0, 1.0])], "id int, t array<double>")
    got = {r.id: r.m for r in df.select("id", timeline.merge_ticks(F.col("t")).alias("m")).collect()}
    assert got[2] == [] and got[3] == [4.0] and got[4] == [1.0, 3.0]
    kept = []
    for x in sorted(round(v, 6) for v in chain):
        if not kept or x - kept[-1] > 1e-6:
            kept.append(x)
    assert got[1] == kept
    errors = df.select("id", timeline.tick_error(F.col("t"), F.lit(3.0)).alias("e")).collect()
    assert {r.id: r.e for r in errors} == {1: "tick beyond duration", 2: None, 3: "tick beyond duration", 4: None}


def model_clips(ticks, least, most, split, trim):
    """Clips of merged ticks, step by step."""
    pieces = []
    for i, (a, b) in enumerate(zip(ticks, ticks[1:])):
        n = math.ceil((b - a - 1e-6) / split) if b - a > most + 1e-6 else 1
        pieces += [(i, k, a + k * split, b if k == n - 1 else a + (k + 1) * split) for k in range(n)]
    out = []
    for j, (i, k, a, b) in enumerate(pieces):
        fits = lambda q: pieces[q][0] != i and b - a > 2 * trim + 1e-6 and pieces[q][3] - pieces[q][2] > 2 * trim + 1e-6
        x = round(a + (trim if j and fits(j - 1) else 0), 6)
        y = round(b - (trim if j + 1 < len(pieces) and fits(j + 1) else 0), 6)
        if y > x and y - x >= least - 1e-6:
            out.append((j, k, x, y))
    return out


def test_clip_timings_against_model(spark):
    import random

    rng, rows = random.Random(3), []
    for i in range(40):
        rows.append((i, sorted({round(rng.uniform(0, 60), rng.choice([0, 3])) for _ in range(rng.randrange(0, 9))})))
    df = spark.createDataFrame(rows, "id int, t array<double>")
    got = {}
    for r in timeline.clip_timings(df, "id", "t", 1.0, 10.0, 6.0, 0.5).orderBy("id", "clip_index").collect():
        got.setdefault(r.id, []).append((r.clip_index, r.split_index, r.start_sec, r.end_sec))
    assert got == {i: m for i, t in rows if (m := model_clips(t, 1.0, 10.0, 6.0, 0.5))}


def test_components_chain_and_junk(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 6), (7, 6), (200, 201), (None, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 200: 200, 201: 200}
    labels_ = graph.components(spark.createDataFrame([(5, 4), (9, 8)], "a long, b long"))
    assert {r.component: r.group_id for r in graph.numbered_groups(labels_, "g").collect()} == {4: "g-000001", 8: "g-000002"}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_group_keep_counts(spark):
    rows = [(i, "g", float(i % 3)) for i in range(10)] + [(20, "", 1.0), (21, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, g string, s double")
    kept = selection.select(df, [rules.Rule("s", "s", min=0, reject_reason="r")], [selection.GroupKeep("m", "g", 0.3, 1, 2)], "s", "id")
    assert {r.id for r in kept.where("select_pass = 1").collect()} == {2, 5, 20, 21}
    with pytest.raises(ValueError):
        selection.GroupKeep("m", "g", 0.0)


def test_hamming_by_parts_and_by_blocks(spark):
    import random

    rng = random.Random(1)
    base = rng.getrandbits(63)
    codes = [(i, base ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(5)))) for i in range(60)]
    df = spark.createDataFrame(codes, "id long, code long")
    for most in (2, 18):
        want = {(i, j, (x ^ y).bit_count()) for i, x in codes for j, y in codes if i < j and (x ^ y).bit_count() <= most}
        assert {tuple(r) for r in similarity.hamming_pairs(df, most, bits=63).collect()} == want


def test_zero_vector_matches_nothing(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, None)], "vec_id long, embedding array<double>")
    assert [(r.a, r.b) for r in similarity.cosine_pairs(df, 0.5).collect()] == [(2, 3)]


def test_labels(spark):
    schema = labels.LabelSchema(single={"view": ["in", "out"]}, multi={"fx": ["none", "zoom", "pan"]})
    rows = ['{"view": "in", "fx": ["zoom", "zoom"]}', '{"view": "in", "fx": ["none", "zoom"]}', '{"view": "up", "fx": ["pan"]}', '{"view": "in"}', '{"view": "in", "fx": ["pan"], "x": 1}', "[1]", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, j string")
    got = df.orderBy("id").select(schema.error(F.col("j")).alias("e"), schema.parse(F.col("j")).alias("p")).collect()
    assert [r.e for r in got] == [None, "fx mixes an exclusive value", "bad view", "missing field", "unknown field", "not an object", "not an object"]
    assert got[0].p.fx == ["zoom"] and got[1].p.view == "unknown"
    salvaged = spark.createDataFrame([('say {"a": 1} ok',)], "s string").select(labels.json_object(F.col("s"), salvage=True)).first()[0]
    assert salvaged == '{"a": 1}'


def test_merge_pass_and_resume(spark):
    rows = spark.createDataFrame([(1, ["a"], 1, "", "x"), (2, ["a"], 0, "bad", "y")], "id int, names array<string>, ok int, error string, j string")
    new = spark.createDataFrame([(1, ["b"], 0, "worse", "z"), (2, ["a"], 1, "", "w")], "id int, names array<string>, ok int, error string, j string")
    got = {r.id: (r.names, r.ok, r.error, r.j) for r in joins.merge_pass(rows, new, "id", "names", "ok", "error").collect()}
    assert got == {1: (["a", "b"], 0, "worse", "z"), 2: (["a"], 0, "bad", "w")}
    assert [r.id for r in joins.resume(rows, new, "id", F.col("ok") == 1).collect()] == [1]


def test_batches_wrap(spark):
    df = spark.createDataFrame([(i, "b" if i < 5 else "c") for i in range(8)], "id int, b string")
    out = sampling.bucket_batches(df, "b", "id", F.col("id"), 2, 4, drop_last=False).collect()
    sizes = {}
    for r in out:
        sizes[(r.b, r.batch, r["rank"])] = sizes.get((r.b, r.batch, r["rank"]), 0) + 1
    assert set(sizes.values()) == {4} and len(sizes) == 4
    dropped = sampling.bucket_batches(df, "b", "id", F.col("id"), 1, 2)
    assert dropped.count() == 6


def test_split_has_no_leak(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    s = sampling.split_without_leaks(o, "o_orderpriority", "o_custkey", "o_orderkey", sampling.portable_order("o_orderkey", 1), 5, 50)
    val = s.where("split = 'val'").select("o_custkey")
    assert s.where("split = 'train'").join(val, "o_custkey", "left_semi").count() == 0 and s.where("split = 'val'").count() == 25


def test_manifest_refuses_blanks(spark, tmp_path):
    bad = spark.createDataFrame([("a b", 1)], "p string, l int")
    with pytest.raises(Exception, match="white space"):
        sampling.manifest_lines(bad, "p", "l").collect()
    (tmp_path / "m.csv").write_text("a.mp4 3\n\nb c.mp4::x\nd.mp4\n")
    assert {tuple(r) for r in shards.read_manifest(spark, str(tmp_path / "m.csv")).collect()} == {("a.mp4", "3"), ("b c.mp4", "x"), ("d.mp4", "0")}


def test_shards_round_trip(spark, tmp_path):
    df = spark.range(25).withColumn("ok_pass", (F.col("id") % 2).cast("long"))
    path = str(tmp_path / "out")
    assert shards.read_unit(spark, path, "clip", df.schema).count() == 0
    shards.write_unit(df, path, "clip", rows_per_shard=10)
    shards.write_unit(spark.range(3).withColumn("ok_pass", F.lit(1).cast("long")), path, "clip", reset=False)
    assert shards.read_unit(spark, path, "clip", df.schema).count() == 28
    assert shards.read_unit(spark, path, "clip", df.schema, where="ok_pass = 1", limit=5).count() == 5
    assert shards.read_unit(spark, path, "clip", df.schema, limit=0).count() == 0
    counts = shards.write_pass_reject(df, str(tmp_path / "three"), "clip", "ok_pass")
    assert counts == {"output_count": 25, "pass_count": 12, "reject_count": 13}
    assert shards.read_unit(spark, str(tmp_path / "three" / "reject"), "clip", df.schema).count() == 13


def test_ids_and_tar(spark, tmp_path):
    import tarfile

    (tmp_path / "ids.txt").write_text("a\n\nb\na\n")
    assert shards.read_ids(spark, [str(tmp_path / "ids.txt")]).count() == 2
    with pytest.raises(ValueError):
        shards.read_ids(spark, [str(tmp_path / "ids.txt")], strict=True)
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "v.MP4").write_text("x")
    with tarfile.open(tmp_path / "raw" / "t.tar", "w:") as t:
        for name in ("in/a.mp4", "../b.mp4", "c.txt"):
            t.addfile(tarfile.TarInfo(name))
    assert shards.raw_files(spark, str(tmp_path / "raw"), [".mp4"]).count() == 1
    assert [r.member for r in shards.tar_members(spark, str(tmp_path / "raw"), [".mp4"]).collect()] == ["in/a.mp4"]


class Doubler:
    def process_batch(self, rows):
        if any(r["v"] < 0 for r in rows):
            raise ValueError("negative")
        return [{"w": r["v"] * 2} for r in rows]


def test_provider_errors_are_data(spark):
    df = spark.createDataFrame([(1,), (-1,), (3,)], "v int").coalesce(1)
    out = providers.apply_provider(df, Doubler, T.StructType([T.StructField("w", T.IntegerType())]), "x")
    assert {(r.v, r.w, r.x_ok, r.x_error) for r in out.collect()} == {(1, 2, 1, ""), (-1, None, 0, "negative"), (3, 6, 1, "")}


def test_streaming_sees_new_shards_only(spark, tmp_path):
    src, sink, chk = (str(tmp_path / x) for x in ("src", "sink", "chk"))
    spark.range(5).write.parquet(src)
    step = lambda df: df.withColumn("y", F.col("id") * 2)
    for n in (5, 8):
        incremental.run_new_shards(spark, src, spark.range(1).schema, step, sink, chk).awaitTermination()
        assert spark.read.parquet(sink).count() == n
        spark.range(100, 103).write.mode("append").parquet(src)


def test_sessions_and_counts_on_tables(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    s = incremental.sessions(e, "user_id", "ts", "30 minutes", "1 hour")
    assert s.agg(F.sum("n")).first()[0] == e.count()
    w = incremental.windowed_counts(e, "ts", "1 day", "1 hour", "event_type")
    assert w.agg(F.sum("n")).first()[0] == e.count()


def test_text_functions(spark):
    df = spark.createDataFrame([("a b/ç..",), ("..",), (None,)], "s string")
    assert [r[0] for r in df.select(text.safe_file_name(F.col("s"))).collect()] == ["a_b", "item", "item"]
    line = spark.range(1).select(text.frame_timeline(F.array(F.lit(1.0), F.lit(-1.0)))).first()[0]
    assert line == "- frame_0000: 1.000s\n- frame_0001: unknown"
    ids = spark.range(1).select(text.blake_id(F.lit("s"), F.lit("b"), F.lit("p"), F.lit(""))).first()[0]
    assert ids.startswith("video-") and len(ids) == 22


def test_geometry(spark):
    assert geometry.frame_buckets([8, 17, 5, 6], 4) == [5, 17] and geometry.pixel_budget(480) == 409600 and geometry.steps_per_epoch(0, 2, 4) == 1
    r = spark.range(1).select(
        geometry.bucket_resolution(F.lit(0), F.lit(5), 100, 16).alias("a"), geometry.centre_crop(F.lit(100), F.lit(50), 1.0).alias("c"),
        geometry.bucket_frames(F.lit(0.1), F.lit(10.0), [5, 17]).alias("f"), geometry.padded_timestamps(F.array(F.lit(0.5)), 3).alias("p"),
        geometry.uniform_pick(F.array(*map(F.lit, range(3))), 5).alias("u"), geometry.uniform_timestamps(F.lit(3), F.lit(2.0), F.lit(0.9)).alias("t"),
    ).first()
    assert r.a is None and (r.c.x, r.c.y, r.c.width, r.c.height) == (25, 0, 50, 50) and r.f is None
    assert r.p == [0.5, -1.0, -1.0] and r.u == [0, 0, 1, 2, 2] and r.t == [0.0, 0.5, 0.9]


def test_histogram_drops_nan_and_fills(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (float("nan"),), (None,), (-1.0,)], "v double")
    got = {(r.bin, r.n) for r in profile.histogram(df, F.col("v"), [0, 1, 2, 3], fill=True).collect()}
    assert got == {(0, 1), (1, 1), (2, 0)}


def test_weighted_sample_is_proportional(spark):
    df = spark.createDataFrame(pd.DataFrame({"id": range(1000), "w": [3.0] * 500 + [1.0] * 500}))
    out = sampling.weighted_sample(df, "w", 4000, 1).groupBy((F.col("id") < 500).alias("big")).agg(F.sum("draws_of").alias("n"))
    n = {r.big: r.n for r in out.collect()}
    assert 2.4 < n[True] / n[False] < 3.8


def slow_bins(frames, duration, fps):
    taken, start, step = [], 0.0, 1 / fps
    while start < duration - 1e-6:
        end = min(start + step, duration)
        free = [f for f in frames if f[0] not in taken]
        inside = [f for f in free if start - 1e-6 <= f[1] < end - 1e-6]
        if not free:
            break
        best = max(inside, key=lambda f: (f[2], -f[0])) if inside else min(free, key=lambda f: abs(f[1] - (start + end) / 2))
        taken.append(best[0])
        start += step
    return sorted(taken)


def test_one_frame_per_bin(spark):
    import random

    from siftwell.functions import frames as V

    rng, rows = random.Random(4), []
    for i in range(40):
        n = rng.randrange(1, 12)
        at = sorted(round(rng.uniform(0, 5), 2) for _ in range(n))
        rows.append((i, [(k, a, float(rng.randrange(3))) for k, a in enumerate(at)], round(rng.uniform(0.5, 6), 1)))
    df = spark.createDataFrame(rows, "id int, f array<struct<index:int,at:double,score:double>>, d double")
    got = {r.id: r.p for r in df.select("id", V.pick_per_bin(F.col("f"), F.col("d"), 2.0).alias("p")).collect()}
    assert got == {i: slow_bins(f, d, 2.0) for i, f, d in rows}


@pytest.mark.parametrize("overlap", [False, True])
def test_clip_indices(spark, overlap):
    import numpy as np

    from siftwell.functions import frames as V

    def model(total, fpc, step, clips):
        length, part, out = fpc * step, total // clips, []
        for c in range(clips):
            if part > length:
                x = np.clip(np.linspace(0, length, fpc), 0, length - 1).astype(int) + c * part
            else:
                span = min(length, total) - 1 if overlap else part
                n = span // step
                x = np.clip(np.append(np.linspace(0, span, n), [span] * max(0, fpc - n)), 0, span - 1).astype(int)
                hop = (total - length) // max(1, clips - 1) if total > length and clips > 1 else 0
                x = x + c * (hop if overlap else part)
            out.append(x.tolist())
        return out

    df = spark.createDataFrame([(n,) for n in (16, 40, 65, 100, 333)], "n int")
    got = {r.n: r.x for r in df.select("n", V.clip_indices(F.col("n"), 8, 4, 2, overlap).alias("x")).collect()}
    assert got == {n: model(n, 8, 4, 2) for n in got}
    assert V.frame_step(16, 29.97, fps=10) == 3 and V.frame_step(16, 30, duration=4.0) == 7


def test_covered_share(spark):
    from siftwell.functions import frames as V

    df = spark.createDataFrame([([[0.0, 0.0, 5.0, 5.0], [2.0, 2.0, 20.0, 7.0]], 10.0, 10.0), ([], 10.0, 10.0)], "b array<array<double>>, w double, h double")
    assert [r[0] for r in df.select(V.covered_share("b", "w", "h")).collect()] == [0.56, 0.0]


def test_prompts_and_coercions(spark):
    from siftwell.functions import prompts as P

    row = spark.createDataFrame([([0.5], "pan", " ", "TRUE", "nan", '["a", "b"]')], "s array<double>, camera string, audio string, b string, n string, l string")
    r = row.select(
        P.build_prompt("Describe.", F.col("s"), camera=F.col("camera"), audio=F.col("audio")).alias("p"), P.coerce_bool(F.col("b")).alias("b"),
        P.coerce_number(F.col("n"), 2.0).alias("n"), P.coerce_names(F.col("l")).alias("l"), P.label_lines(F.struct("camera"), ["camera"]).alias("x"),
    ).first()
    assert r.p == "Describe.\n\nFrames:\n- frame_0000: 0.500s\n\nCamera:\npan"
    assert (r.b, r.n, r.l, r.x) == (True, 2.0, ["a", "b"], "camera: pan")


def test_metadata_round_trip(spark, tmp_path):
    from siftwell.sources import metadata

    df = spark.range(25).select(F.format_string("c%03d", "id").alias("clip_id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    names = metadata.write_metadata(df, str(tmp_path), "clip_id", 10)
    assert names == [f"shards/metadata-{i:06d}.json" for i in range(3)]
    back = metadata.read_metadata(spark, str(tmp_path), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    import json

    assert [x["clip_id"] for x in json.loads((tmp_path / names[1]).read_text())] == [f"c{i:03d}" for i in range(10, 20)]
