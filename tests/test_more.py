"""Edge cases of outputs, features, schemas, sampling and texts."""

import datetime
import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions import frames, geometry, prompts, text
from siftwell.operators import graph, joins, labels, profile, rules, sampling, selection, similarity
from siftwell.sources import features, metadata, outputs, shards


def test_commit_folder(spark, tmp_path):
    target = str(tmp_path / "out")
    outputs.commit_folder(spark, target, lambda p: spark.range(3).write.parquet(p))
    with pytest.raises(FileExistsError):
        outputs.commit_folder(spark, target, lambda p: spark.range(5).write.parquet(p))

    def fails(p):
        spark.range(9).write.parquet(p)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        outputs.commit_folder(spark, target, fails, overwrite=True)
    assert spark.read.parquet(target).count() == 3
    outputs.commit_folder(spark, target, lambda p: spark.range(5).write.parquet(p), overwrite=True)
    assert spark.read.parquet(target).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_reset_output(spark, tmp_path):
    for name in ("832x480/a", "49f/b", "keep/c", "shards/d"):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text("x")
    (tmp_path / "keep/x.meta.tmp").write_text("x")
    (tmp_path / "metadata.json").write_text("{}")
    outputs.reset_output(spark, str(tmp_path), resume=True)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["49f", "832x480", "keep"]
    outputs.reset_output(spark, str(tmp_path), resume=False)
    assert [p.name for p in tmp_path.rglob("*")] == ["keep", "c"]


def test_runs_and_shards_of_a_summary(spark, tmp_path):
    assert outputs.run_ids(spark, str(tmp_path / "none")) == []
    for name in ("run_id=20", "30", "run_id=10"):
        (tmp_path / name).mkdir()
    assert outputs.run_ids(spark, str(tmp_path)) == ["30", "20", "10"]
    assert outputs.run_path(spark, str(tmp_path), "20").endswith("run_id=20") and outputs.run_path(spark, str(tmp_path), "30").endswith("/30")
    unit = str(tmp_path / "30")
    shards.write_unit(spark.range(25).coalesce(1), unit, "clip", rows_per_shard=10)
    names = lambda summary: [p.rsplit("/", 1)[1] for p in outputs.summary_shards(spark, unit, summary, "clip")]
    assert names({"shards": [{"path": "clip-00001.parquet"}, {"path": "gone.parquet"}]}) == ["clip-00001.parquet"]
    assert names({}) == ["clip-00000.parquet", "clip-00001.parquet", "clip-00002.parquet"]
    assert shards.unit_summary(spark, unit, "clip") == {"total_rows": 25, "shard_count": 3, "shards": [{"path": f"clip-0000{i}.parquet", "rows": n} for i, n in enumerate((10, 10, 5))]}
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert [shards.count_unit(spark, unit, "clip", schema, limit=n) for n in (None, 7, 0)] == [25, 7, 0] and shards.count_unit(spark, unit, "clip", schema, where="id > 20") == 4


def test_a_failed_write_keeps_old_shards(spark, tmp_path, monkeypatch):
    unit = str(tmp_path / "u")
    shards.write_unit(spark.range(4), unit, "clip")
    (tmp_path / "u" / "clip-00000.parquet").rename(tmp_path / "u" / "clip-00007.parquet")
    before = sorted(r.id for r in spark.read.parquet(unit).collect())
    real = shards._fs

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return False if "_staging" in a.toString() else self.fs.rename(a, b)

    monkeypatch.setattr(shards, "_fs", lambda s, p: (Broken(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError):
        shards.write_unit(spark.range(9), unit, "clip")
    assert sorted(r.id for r in spark.read.option("pathGlobFilter", "clip-*").parquet(unit).collect()) == before


def test_id_lists_manifests_and_single_files(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", "v"), (1, "a", "w"), (3, "c", "v")], "n int, clip_id string, video_id string")
    outputs.write_id_lists(df, str(tmp_path / "ids"), "n")
    read = lambda name: [r.value for r in spark.read.text(str(tmp_path / "ids" / name)).collect()]
    assert read("clip_ids.txt") == ["a", "b", "c"] and read("video_ids.txt") == ["v", "w"]
    lines = sampling.manifest_lines(df, "clip_id", "n")
    assert shards.write_manifest(lines, str(tmp_path / "m")) == 3
    with pytest.raises(ValueError):
        shards.write_manifest(lines.limit(0), str(tmp_path / "m2"))
    assert not (tmp_path / "m2").exists()
    fallback = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    shards.write_single(df.limit(0), str(tmp_path / "one"), fallback)
    assert spark.read.parquet(str(tmp_path / "one")).columns == ["a", "b"]
    (tmp_path / "npy").mkdir()
    np.save(tmp_path / "npy" / "x.npy", np.array(["p.mp4", "q.mp4"]))
    assert sorted(tuple(r) for r in shards.read_npy_manifest(spark, str(tmp_path / "npy" / "*.npy")).collect()) == [("p.mp4", "0"), ("q.mp4", "0")]
    assert [r[0] for r in spark.createDataFrame([("3",), ("x",)], "l string").select(shards.label_number(F.col("l"))).collect()] == [3.0, None]


def test_summary_is_patched(spark, tmp_path):
    shards.write_summary(spark, str(tmp_path), {"b": 1, "a": "é"})
    start = datetime.datetime.now(tz=datetime.UTC) - datetime.timedelta(seconds=5)
    out = shards.patch_summary(spark, str(tmp_path), {"b": 2}, start)
    assert out == shards.read_summary(spark, str(tmp_path)) and out["b"] == 2 and out["a"] == "é" and out["elapsed_sec"] >= 5
    assert datetime.datetime.fromisoformat(out["finished_at"]).tzinfo


def test_raw_videos(spark, tmp_path):
    for name in ("b.mp4", "sub/a.MP4", "meta/x.mp4", "data/stage2_x/y.mp4", "data/own.mp4", "n.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"v")
    with tarfile.open(tmp_path / "c.tar", "w") as t:
        for name in ("in/z.mp4", "../up.mp4", "in/t.txt"):
            info = tarfile.TarInfo(name)
            info.size = 3
            t.addfile(info, io.BytesIO(b"abc"))
    got = [(r.raw_type, r.raw_path.rsplit(tmp_path.name, 1)[1], r.raw_member_path) for r in shards.raw_videos(spark, str(tmp_path), [".mp4"]).collect()]
    assert got == [("file", "/b.mp4", ""), ("tar", "/c.tar", "in/z.mp4"), ("file", "/data/own.mp4", ""), ("file", "/sub/a.MP4", "")]
    with shards.localised(str(tmp_path / "c.tar"), "in/z.mp4", str(tmp_path)) as p:
        assert open(p, "rb").read() == b"abc"
    with shards.localised(str(tmp_path / "b.mp4"), "") as p:
        assert p == str(tmp_path / "b.mp4")
    assert not list(tmp_path.glob("tmp*"))


def test_feature_store(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "", [1, 2]), ("b", 0, "bad", None), ("c", 1, "", [])], "clip_id string, ok int, error string, hashes array<long>")
    path = str(tmp_path / "f")
    assert features.save_features(df, path, "hashes", "pdq", "v1")["value_count"] == 2
    assert {r.clip_id: r.value_count for r in features.load_features(spark, path).collect()} == {"a": 2, "b": 0, "c": 0}
    spark.createDataFrame([("d", 1, "", [1, 2], 1)], "clip_id string, ok int, error string, hashes array<long>, value_count int").write.mode("append").parquet(f"{path}/features")
    with pytest.raises(ValueError):
        features.load_features(spark, path)


def test_metadata_items_are_checked(spark, tmp_path):
    path = str(tmp_path / "m")
    metadata.write_metadata(spark.createDataFrame([(1, "a"), (2, "b"), (3, " ")], "id int, cache string"), path, "id", 2)
    assert metadata.read_metadata(spark, path, limit=2).count() == 2 and metadata.read_metadata(spark, path, limit=-1).count() == 0
    with pytest.raises(Exception, match="without cache"):
        metadata.read_metadata(spark, path, required=["cache"]).collect()


CAMERA = {
    "motion_type": "simple-motion", "steadiness": "static", "speed": "slow", "scene_dynamics": "dynamic", "effects": ["motion-blur", "motion-blur"],
    "rotation": {"pan": "no-pan", "tilt": "tilt-up", "roll": "unknown"}, "translation": {"dolly": "dolly-in", "pedestal": "no-pedestal", "truck": "unknown"}, "intrinsic": {"zoom": "no-zoom"},
    "object_centric": {"arc": "no-arc", **{f"{k}_tracking": "unknown" for k in ("arc", "lead", "tail", "side", "aerial", "pan", "tilt")}, "subject_size_change": "unknown"},
}


def test_camera_labels(spark):
    def but(**change):
        return json.dumps(CAMERA | change)

    cases = [
        (json.dumps(CAMERA), None), (but(speed="quick"), "bad speed"), (but(effects=["none", "motion-blur"]), "effects mixes an exclusive value"), (but(extra=1), "unknown field"),
        (but(rotation={"pan": "no-pan", "tilt": "tilt-up"}), "bad rotation"), (but(rotation=CAMERA["rotation"] | {"roll": "spin"}), "bad rotation.roll"), (but(intrinsic={"zoom": "no-zoom", "x": 1}), "bad intrinsic"), (but(intrinsic="no"), "bad intrinsic"), ("[]", "not an object"), (None, "not an object"),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "id int, j string")
    out = df.select("id", labels.CAMERA.error(F.col("j")).alias("e"), labels.CAMERA.parse(F.col("j")).alias("l")).orderBy("id").collect()
    assert [r.e for r in out] == [e for _, e in cases]
    assert out[0].l.rotation.tilt == "tilt-up" and out[0].l.effects == ["motion-blur"] and out[1].l.translation.dolly == "unknown" and out[1].l.effects == ["unknown"]
    flat = df.select("id", labels.CAMERA.parse(F.col("j")).alias("l")).select(*labels.CAMERA.flat(F.col("l"), "camera"))
    assert "camera_object_centric_lead_tracking" in flat.columns and len(flat.columns) == 4 + 3 + 3 + 1 + 9 + 1
    counts = {(r.field, r.label): r.n for r in labels.all_label_counts(df.select(labels.CAMERA.parse(F.col("j")).alias("l")), F.col("l"), labels.CAMERA).collect()}
    assert counts["rotation.tilt", "tilt-up"] == 1 and counts["rotation.tilt", "tilt-down"] == 0 and counts["rotation.tilt", "unknown"] == 9 and len(counts) == len(labels.CAMERA.domains())


def test_caption_labels(spark):
    df = spark.createDataFrame([('{"level_0": "a", "level_1": "b", "level_2": "c", "level_3": "d"}',), ('{"level_0": "a"}',)], "j string")
    got = df.select(labels.CAPTION.error(F.col("j")).alias("e"), *labels.CAPTION.flat(labels.CAPTION.parse(F.col("j")), "caption")).collect()
    assert [tuple(r) for r in got] == [(None, "d", "c", "b", "a"), ("missing field", "", "", "", "")]


def test_default_rules(spark):
    df = spark.createDataFrame([(1, 720, 30.0, 10.0), (0, 100, 5.0, 900.0), (1, None, None, 0.5)], "probe_ok int, short_side int, fps double, duration_sec double")
    got = [r.screen_reject_reason for r in rules.check(df, rules.SCREEN_RULES, "screen").collect()]
    assert got == ["", "probe_failed;resolution_too_low;fps_too_low;duration_too_long", "resolution_too_low;fps_too_low;duration_too_short"]
    assert [m.name for m in selection.SELECT_GROUPS] == ["pdq", "cosmos"] and [r.reject_reason for r in selection.SELECT_RULES][-1] == "dedup_failed"


def test_complete_rows(spark):
    df = spark.createDataFrame([("1", "f", "2", "[1]"), ("1", " ", "2", "[1]"), ("x", "f", "2", "[1]"), ("1", "f", "0", "[1]"), ("1", "f", "2", "[]"), ("1", "f", "2", "{bad"), (None, None, None, None)], "ok string, file string, n string, shape string")
    assert [r[0] for r in df.select(rules.cached(F.col("ok"), F.col("file"), [F.col("n")], F.col("shape"))).collect()] == [True] + [False] * 6
    assert [r[0] for r in df.select(rules.usable(F.col("file"), F.col("ok"))).collect()] == [True, False, False, True, True, True, False]
    df = spark.createDataFrame([('{"frame_paths": ["a"]}', 0, None), ('{"frame_paths": []}', 0, None), ('{"frame_paths": ["a"]}', 1, "{}"), ('{"frame_paths": ["a"]}', 1, '{"audio_paths": ["b"]}'), ("bad", 0, None)], "f string, ok int, a string")
    assert [r[0] for r in df.select(rules.context_complete(F.col("f"), F.col("ok"), F.col("a"))).collect()] == [True, False, False, True, False]


def test_ordered_fetch_errors(spark):
    rows = spark.createDataFrame([("a", "p"), ("a", "p"), ("b", "q"), ("c", "r"), ("c", "s")], "id string, path string")
    wanted = lambda *ids: spark.createDataFrame(list(enumerate(ids)), "pos int, id string")
    assert [r.path for r in joins.ordered_fetch(rows, wanted("b", "a"), "id", "pos", "path").collect()] == ["q", "p"]
    with pytest.raises(ValueError, match="differ"):
        joins.ordered_fetch(rows, wanted("c"), "id", "pos", "path")
    with pytest.raises(ValueError, match="no row"):
        joins.ordered_fetch(rows, wanted("z"), "id", "pos", "path")


def test_unknown_nodes_are_an_error(spark):
    pairs, nodes = spark.createDataFrame([(1, 2), (2, 9)], "a int, b int"), spark.createDataFrame([(1,), (2,)], "node int")
    with pytest.raises(ValueError, match="unknown node 9"):
        graph.components(pairs, nodes=nodes)
    assert graph.components(pairs.where("b < 9"), nodes=nodes).count() == 2


def test_latest_with_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 3, "y"), (2, None, "z"), (None, 1, "n")], "k int, t int, v string")
    assert sorted((r.k or 0, r.v) for r in selection.latest(df, "k", [F.col("t"), F.col("v")]).collect()) == [(0, "n"), (1, "y"), (2, "z")]


def test_numbers_by_range(spark):
    df = spark.createDataFrame([(i % 3 if i % 7 else None, i) for i in range(200)], "b int, id int").repartition(7)
    got = sampling.numbered(df, ["id"], "b").collect()
    for b in (None, 0, 1, 2):
        own = sorted((r.id, r.rn, r.n) for r in got if r.b == b)
        assert [r[1] for r in own] == list(range(len(own))) and {r[2] for r in own} == {len(own)}
    order = sampling.shuffled_batches(sampling.bucket_batches(df.where("b is not null"), "b", "id", F.col("id"), 2, 4), "b", "batch", 5).collect()
    assert sorted(r.step for r in order) == list(range(len(order))) and len(order) > 15


def test_weighted_draws(spark):
    df = spark.createDataFrame([(i, 9.0 if i < 50 else 1.0) for i in range(100)] + [(100, 0.0), (101, None)], "id int, w double")
    out = sampling.weighted_draws(df, "w", "id", 4000, 1, 4).toPandas()
    assert len(out) == 4000 and 0.87 < (out.id < 50).mean() < 0.93 and out["rank"].nunique() == 4 and out.id.max() < 100
    assert sampling.weighted_draws(df.where("id >= 100"), "w", "id", 10, 1).count() == 0


def test_hamming_matches_of_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63 - 1, (6, 4))
    codes = [(i, [int(x) for x in base[i % 6]]) for i in range(60)]
    codes += [(100 + i, [int(np.int64(base[i % 6][0]) ^ np.int64((1 << i) - 1)), *map(int, base[i % 6][1:])]) for i in range(1, 40, 3)]
    df = spark.createDataFrame(codes, "id long, code array<long>")
    far = lambda x, y: sum(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(x, y))
    got = {}
    for r in similarity.hamming_matches(df, 31, 4).collect():
        got.setdefault(r.a, []).append((r.distance, r.b))
    for i, c in codes:
        want = sorted((d, j) for j, o in codes if j != i and (d := far(c, o)) <= 31)[:4]
        assert sorted(got.get(i, [])) == want


def test_parts_of_equal_codes(spark):
    df = spark.createDataFrame([(i, 7) for i in range(5)] + [(9, 6), (10, 1 << 40)], "id long, code long")
    got = sorted((r.a, r.b, r.distance) for r in similarity.hamming_pairs(df, 1).collect())
    assert got == sorted([(i, j, 0) for i in range(5) for j in range(i + 1, 5)] + [(i, 9, 1) for i in range(5)])


def test_polygons(spark):
    df = spark.createDataFrame([([[0.0, 0.0, 9.0, 4.0]], [0.9]), ([[0.0, 0.0, 9.0, 4.0], [0.0, 0.0, 9.0, 0.0, 9.0, 9.0, 0.0, 9.0]], [0.9, 0.4]), ([[0.0, 0.0, 4.0, 0.0, 0.0, 4.0]], [0.6]), ([[1.0, 1.0, 5.0, 5.0, 9.0, 9.0][:4]], [0.1]), (None, None)], "p array<array<double>>, s array<double>")
    got = [r[0] for r in df.select(frames.polygon_share("p", "s", F.lit(10), F.lit(10), F.lit(0.5))).collect()]
    assert got == [0.5, 0.5, 0.15, 0.0, 0.0]


def test_shifted_clips(spark):
    df = spark.range(200).select("id", F.lit(200).alias("n"))
    out = df.select("id", frames.clip_indices(F.col("n"), 4, 6, 2, shift=frames.random_shift(F.col("id"), 7)).alias("x")).collect()
    starts = {r.x[0][0] for r in out}
    assert min(starts) >= 0 and max(starts) < 100 - 24 and len(starts) > 40
    assert all([b - r.x[c][0] for b in r.x[c]] == [0, 8, 16, 23] and c * 100 <= r.x[c][0] < (c + 1) * 100 - 24 for r in out for c in (0, 1))


def test_encoder_frames(spark):
    df = spark.createDataFrame([(list(range(n)),) for n in (5, 6, 9)], "a array<int>")
    assert [list(r[0]) for r in df.select(geometry.encoder_pick(F.col("a"), 8)).collect()] == [[0, 1, 1, 2, 2, 3, 3, 4], [0, 1, 1, 2, 3, 4, 4, 5], [0, 1, 2, 3, 5, 6, 7, 8]]
    with pytest.raises(Exception, match="4 of 8 frames missing"):
        spark.createDataFrame([([1, 2, 3, 4],)], "a array<int>").select(geometry.encoder_pick(F.col("a"), 8)).collect()


def test_texts(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(text.human_bytes(F.lit(n))) for n in (-1, 0, 1023, 1536, 5 * 1024**3)] == ["-", "0 B", "1023 B", "1.50 KB", "5.00 GB"]
    assert [one(text.human_seconds(F.lit(s))) for s in (-1.0, 12.34, 245.0, 7391.0)] == ["-", "12.3s", "4m 05s", "2h 03m"]
    assert one(text.replace_component(F.lit("a/b/bc/b"), "b", "x")) == "a/x/bc/x"
    assert one(text.clean_prompt(F.lit("  a &amp;amp; b\n cafÃ© "))) == "a & b café"
    assert text.component_spec(" select_pass=1, count=10") == {"select_pass": 1, "count": 10}
    for bad in ("", "select_pass=1", "select_pass=2,count=1", "select_pass=1,count=0", "select_pass=1,count=1,count=2", "select_pass=1,count=1,x=1"):
        with pytest.raises(ValueError):
            text.component_spec(bad)
    assert one(text.cache_path(F.lit("a b"), F.lit(5), F.lit(8), F.lit(4))).startswith("5f/8x4/")
    assert one(prompts.caption_prompt("Say.", F.array(F.lit(1.0)), F.lit(""), F.lit("pan: no"), F.lit("t"))) == "Say.\n\nFrames:\n- frame_0000: 1.000s\n\nCamera labels:\npan: no\n\nTags:\nt"
    assert one(prompts.coerce_optional(F.lit(" Null "))) is None and one(profile.rate_text(F.lit(29.970))) == "29.97"
