"""Text repair, manifests of splits, labels with versions."""

import json

import pytest
from pyspark.sql import functions as F

from siftwell.functions import text
from siftwell.functions.repair import repaired
from siftwell.operators import labels
from siftwell.sources import manifests, metadata, shards

CLEAN = ["plain", "naïve café", "Müller Straße über Größe", "Привет, мир", "日本語テキスト", "São Paulo NÃO É", "Ω≈ç√ résumé", "½ ° ± £5 €6 © ™", "Ça va? À bientôt Â quoi", "Ñandú Ðorđe", "Tiếng Việt", "Україна їжак", "a\tb\nc", "emoji 👍🏽 ok"]


def misread(t, encoding):
    return "".join(next(iter(bytes([b]).decode(encoding, "ignore")), chr(b)) for b in t.encode())


@pytest.mark.parametrize("clean", CLEAN)
def test_clean_text_stays_and_damage_is_undone(clean):
    assert repaired(clean) == clean
    for encoding in ("windows-1252", "latin-1"):
        once = misread(clean, encoding)
        assert repaired(once) == clean and repaired(misread(once, encoding)) == clean


def test_known_damage():
    known = {
        "Itâ€™s fine": "It's fine", "schÃ¶n": "schön", "schÃƒÂ¶n": "schön", "â€œquotedâ€\x9d": '"quoted"', "na√Øve caf√©": "naïve café", "M├╝ller": "Müller", "cafГ©": "café",
        "ÐŸÑ€Ð¸Ð²ÐµÑ‚": "Привет", "æ—¥æœ¬": "日本", "ðŸ‘\x8d": "👍", "5 Â£ â‚¬": "5 £ €", "naïve and cafÃ©": "naïve and café",
        "“curly” ‘quotes’": "\"curly\" 'quotes'", "ﬁne ﬂow": "fine flow", "ＡＢＣ１２": "ABC12", "a\r\nb\rc d": "a\nb\nc\nd", "\x1b[31mred\x1b[0m\x00": "red", "é": "é", "﻿bom": "bom",
    }
    assert {k: repaired(k) for k in known} == known


def test_clean_prompt_column(spark):
    df = spark.createDataFrame([("  a&amp;amp;b \n schÃ¶n ",), (None,), ("",)], "p string")
    assert [r.p for r in df.select(text.clean_prompt("p").alias("p")).collect()] == ["a&b schön", None, ""]


def test_manifest_of_a_split(spark, tmp_path):
    media = tmp_path / "media"
    media.mkdir()
    for i in range(30):
        (media / f"{i}.mp4").write_bytes(b"x" * (i != 7))
    rows = spark.createDataFrame([(f"c{i}", f"v{i % 4}", f"{media}/{i}.mp4") for i in range(30)] + [("c3", "v3", f"{media}/3.mp4")], "clip_id string, video_id string, clip_path string")
    (tmp_path / "ids.txt").write_text("".join(f"c{i}\n\n" for i in (9, 3, 21, 0)))
    ids = manifests.listed_ids(spark, str(tmp_path / "ids.txt"))
    files = manifests.existing_files(spark, [str(media)])
    out = str(tmp_path / "out")
    summary = manifests.manifest_from_split(ids, rows, out, label=2, files=files)
    assert (summary["row_count"], summary["unique_video_id_count"], summary["label"], summary["check_files"]) == (4, 3, 2, True)
    assert [r.value for r in spark.read.text(f"{out}/train.csv").collect()] == [f"{media}/{i}.mp4 2" for i in (9, 3, 21, 0)]
    assert [r.value for r in spark.read.text(f"{out}/clip_ids.txt").collect()] == ["c9", "c3", "c21", "c0"]
    assert shards.read_summary(spark, out)["parquet"]["total_rows"] == 4
    got = spark.read.option("pathGlobFilter", "clip-*.parquet").parquet(out)
    assert sorted(r.clip_id for r in got.where(F.col("manifest_path") == f"{out}/train.csv").collect()) == ["c0", "c21", "c3", "c9"]
    bad = [
        (FileExistsError, ids, rows, {}), (ValueError, ids.withColumn("clip_id", F.lit("c1")), rows, {"overwrite": True}), (ValueError, ids, rows.where("clip_id <> 'c21'"), {"overwrite": True}),
        (ValueError, ids, rows, {"name": "x/y.csv"}), (ValueError, ids, rows, {"rows_per_shard": 0}),
        (FileNotFoundError, ids.withColumn("clip_id", F.when(F.col("clip_id") == "c9", "c7").otherwise(F.col("clip_id"))), rows, {"overwrite": True, "files": files}),
    ]
    for kind, i, r, more in bad:
        with pytest.raises(kind):
            manifests.manifest_from_split(i, r, out, **more)
    with pytest.raises(Exception, match="white space"):
        manifests.manifest_from_split(ids, rows.withColumn("clip_path", F.lit("a b")), out, overwrite=True)
    assert spark.read.text(f"{out}/train.csv").count() == 4  # what was there stays
    odd = spark.createDataFrame([(f"file:{media}/1.mp4",), (f"{media}/7.mp4",), (f"{media}/none.mp4",), (None,), (" ",)], "p string")
    assert [r.file_ok for r in manifests.with_file(odd, "p", files).collect()].count(True) == 1


def test_versions_of_camera_labels(spark):
    s = labels.CAMERA_OUTPUT
    good = {k: v[0] for k, v in s.single.items()} | s.fixed | {g: {k: v[0] for k, v in f.items()} for g, f in s.groups.items()} | {"effects": ["none"]}
    cases = {"good": good, "old": good | {"label_version": "camera_v0"}, "none": {k: v for k, v in good.items() if k != "prompt_version"}, "null": good | {"label_version": None}}
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()], "name string, j string").select("name", s.error(F.col("j")).alias("e"), s.parse(F.col("j")).alias("l"))
    got = {r.name: (r.e, r.l.label_version, r.l.prompt_version, r.l.motion_type) for r in df.collect()}
    assert got == {
        "good": (None, "camera_v1", "camera_qa_v1", "no-motion"), "old": ("bad label_version", "camera_v1", "camera_qa_v1", "unknown"),
        "none": ("missing field", "camera_v1", "camera_qa_v1", "unknown"), "null": ("bad label_version", "camera_v1", "camera_qa_v1", "unknown"),
    }
    assert len(labels.CAMERA.domains()) == len(s.domains()) and len(s.fields()) == len(labels.CAMERA.fields()) + 2


def test_shards_of_items(spark, tmp_path):
    df = spark.range(25).selectExpr("id", "string(id % 3) as source")
    names = metadata.write_metadata(df, str(tmp_path), "id", 10)
    items = metadata.read_metadata(spark, str(tmp_path), "id long, source string", shard_col="shard")
    got = {(r.kind, r.value): (r["rows"], r.invalid_rows) for r in metadata.dataset_parts(items, F.col("id") > 0, shard="shard", source="source").collect()}
    assert got == {("shard", n.split("/")[1]): (c, b) for n, c, b in zip(names, (10, 10, 5), (1, 0, 0))} | {("source", "0"): (9, 1), ("source", "1"): (8, 0), ("source", "2"): (8, 0)}
