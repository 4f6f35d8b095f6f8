"""Sharded Parquet units, manifests, id lists and summaries."""

from __future__ import annotations

import contextlib
import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_unit(spark: SparkSession, path: str, unit: str, schema: T.StructType, columns: list[str] | None = None, where=None, limit: int | None = None) -> DataFrame:
    """Rows of the `<unit>-*.parquet` shards directly in a directory; a missing one gives an empty table of the schema.

    The limit counts rows behind the filter; one of zero or less gives none.
    """
    if exists(spark, path):
        df = spark.read.schema(schema).option("pathGlobFilter", f"{unit}-*.parquet").parquet(path)
    else:
        df = spark.createDataFrame([], schema)
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df if limit is None else df.limit(max(0, limit))


def _footers(spark: SparkSession, path: str, unit: str, schema: T.StructType) -> DataFrame:
    """The shards of a unit through the reader that answers counts and bounds from the files' footers, in a session of its own, as that is a setting of the session."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(schema).option("pathGlobFilter", f"{unit}-*.parquet").parquet(path)


def footer_stats(spark: SparkSession, path: str, unit: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """One row: `rows`, and <column>_min and <column>_max of number, boolean and date columns; no data page is read."""
    stats = [f(F.col(c)).alias(f"{c}_{f.__name__}") for c in columns or [] for f in (F.min, F.max)]
    return _footers(spark, path, unit, schema).agg(F.count(F.lit(1)).alias("rows"), *stats)


def count_unit(spark: SparkSession, path: str, unit: str, schema: T.StructType, where=None, limit: int | None = None) -> int:
    """Rows of a unit, up to the limit; without a filter the counts are those of the files' footers. A missing directory has none."""
    if where is None and exists(spark, path):
        n = footer_stats(spark, path, unit, schema).first()["rows"]
    else:
        n = read_unit(spark, path, unit, schema, where=where).count()
    return n if limit is None else min(n, max(0, limit))


def write_unit(df: DataFrame, path: str, unit: str, rows_per_shard: int = 500_000, reset: bool = True, counts: dict | None = None) -> dict:
    """Writes shards named `<unit>-*`, of so many rows at most; without reset they are added to those there.

    Returns `rows` and further `counts` (aggregates by name), which are observed while the rows are written, not by another pass.
    Spark writes into a folder of its own beside the target; its files are then renamed. With reset, the old
    shards are moved aside first and deleted last; a failure in between moves them back.
    """
    spark = df.sparkSession
    root = path.rstrip("/")
    staging, aside = f"{root}/_staging_{unit}", f"{root}/_old_{unit}"
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()])
    observed.write.mode("overwrite").option("maxRecordsPerFile", rows_per_shard).parquet(staging)
    fs, target = _fs(spark, root)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    named = lambda at, start: sorted((s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith(start)))
    old, new, done = named(target, f"{unit}-"), named(Path(staging), "part-"), []

    def move(a: str, b: str) -> None:
        if not fs.rename(Path(a), Path(b)):
            raise OSError(f"{a} could not become {b}")
        done.append((a, b))

    at = 0 if reset else 1 + max((int(n.split("-")[1].split(".")[0]) for n in old), default=-1)
    try:
        if reset and old:
            fs.mkdirs(Path(aside))
            for n in old:
                move(f"{root}/{n}", f"{aside}/{n}")
        for n in new:
            move(f"{staging}/{n}", f"{root}/{unit}-{at:05d}.parquet")
            at += 1
    except Exception:
        for a, b in reversed(done):
            fs.rename(Path(b), Path(a))
        raise
    fs.delete(Path(aside), True)
    fs.delete(Path(staging), True)
    return seen.get


def unit_summary(spark: SparkSession, path: str, unit: str) -> dict:
    """total_rows, shard_count and shards (path, rows) of a unit; one row a shard reaches the driver."""
    rows = spark.read.option("pathGlobFilter", f"{unit}-*.parquet").parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
    shards = sorted(({"path": r["f"].rsplit("/", 1)[-1], "rows": r["n"]} for r in rows), key=lambda s: s["path"])
    return {"total_rows": sum(s["rows"] for s in shards), "shard_count": len(shards), "shards": shards}


def write_single(df: DataFrame, path: str, fallback: T.StructType) -> None:
    """One Parquet file in a folder, for small tables; a table without columns or rows is written with the fallback's columns."""
    spark = df.sparkSession
    rows = df if df.columns and not df.isEmpty() else spark.createDataFrame([], fallback)
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def write_summary(spark: SparkSession, path: str, summary: dict) -> None:
    """summary.json with sorted keys, ASCII."""
    fs, p = _fs(spark, f"{path}/summary.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(summary, sort_keys=True, ensure_ascii=True, indent=2).encode()))
    out.close()


def read_summary(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r.value for r in spark.read.option("wholetext", "true").text(f"{path}/summary.json").collect()))


def patch_summary(spark: SparkSession, path: str, updates: dict, started: datetime | None = None) -> dict:
    """summary.json with updates, finished_at (ISO, UTC) and, from the start, elapsed_sec."""
    now = datetime.now(tz=UTC)
    out = read_summary(spark, path) | updates | {"finished_at": now.isoformat()}
    if started is not None:
        out["elapsed_sec"] = round((now - started).total_seconds(), 3)
    write_summary(spark, path, out)
    return out


def write_pass_reject(df: DataFrame, path: str, unit: str, passed: str) -> dict:
    """All rows, and those that pass and fail in folders of their own; returns the counts.

    df is computed once: its counts are observed while all rows are written, and the two parts are read from what was written.
    """
    spark = df.sparkSession
    fine = F.col(passed).eqNullSafe(F.lit(1))
    n = write_unit(df, path, unit, counts={"passed": F.count_if(fine)})
    written = read_unit(spark, path, unit, df.schema)
    for name, rows, expected in (("pass", written.where(fine), n["passed"]), ("reject", written.where(~fine), n["rows"] - n["passed"])):
        got = write_unit(rows, f"{path}/{name}", unit)["rows"]
        if got != expected:
            raise RuntimeError(f"{got} rows in {path}/{name} instead of {expected}")
    counts = {"output_count": n["rows"], "pass_count": n["passed"], "reject_count": n["rows"] - n["passed"]}
    write_summary(spark, path, counts)
    return counts


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, label): lines cut at `::` or else at the first blank; the label as text, `0` if there is none. label_number() reads it."""
    line = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''")
    by_colons = F.col("v").contains("::")
    p = F.when(by_colons, F.split("v", "::", 2)[0]).otherwise(F.regexp_extract("v", r"^(\S+)", 1))
    label = F.when(by_colons, F.split("v", "::", 2)[1]).otherwise(F.regexp_extract("v", r"^\S+\s+(.*)$", 1))
    return line.select(F.trim(p).alias("path"), F.coalesce(F.nullif(F.trim(label), F.lit("")), F.lit("0")).alias("label"))


def label_number(label):
    """The label as a number, null if it is text."""
    return label.try_cast("double")


def read_npy_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, label) of .npy files of paths, all of label 0; each file is read by one task."""
    import io

    import numpy as np
    import pandas as pd

    def rows(frames):
        for pdf in frames:
            for content in pdf["content"]:
                paths = np.load(io.BytesIO(content), allow_pickle=False).astype(str).ravel()
                yield pd.DataFrame({"path": paths, "label": "0"})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, "path string, label string")


def write_manifest(lines: DataFrame, path: str) -> int:
    """Writes the lines of manifest_lines() as text and returns their number; none are an error, and then nothing stays."""
    spark = lines.sparkSession
    lines.write.mode("overwrite").text(path)
    n = spark.read.text(path).count()
    if not n:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
        raise ValueError(f"no rows for {path}")
    return n


def read_ids(spark: SparkSession, paths: list[str], strict: bool = False) -> DataFrame:
    """Distinct ids of text files, blanks dropped; strict refuses empty lists and repeats."""
    rows = spark.read.text(paths).select(F.trim("value").alias("id")).where("id <> ''")
    if strict:
        if rows.isEmpty():
            raise ValueError("no ids")
        if not rows.groupBy("id").count().where("count > 1").isEmpty():
            raise ValueError("repeated ids")
    return rows.distinct()


def raw_files(spark: SparkSession, root: str, suffixes: list[str], prune: bool = False) -> DataFrame:
    """(path, length) of files with these suffixes below a folder; contents are not read. prune leaves out meta/ and data/stageN_* right below it."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    if prune:
        fs, p = _fs(spark, root)
        top = fs.resolvePath(p).toUri().getPath().rstrip("/")
        below = F.regexp_replace("path", r"^[a-z0-9]+:(//[^/]*)?", "").substr(F.lit(len(top) + 2), F.char_length("path"))
        df = df.where(~below.rlike(r"^(meta|data/stage\d+_[^/]*)/"))
    return df.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin([s.lower() for s in suffixes]))


def tar_members(spark: SparkSession, root: str, suffixes: list[str], prune: bool = False) -> DataFrame:
    """(path, member) of safe members of plain tar files below a folder; absolute and upward names are left out.

    Only headers are read: a task opens each file by its address and seeks from one header to the next.
    """
    ends = tuple(s.lower() for s in suffixes)

    def members(frames):
        import tarfile

        import pandas as pd
        from pyarrow import fs

        for pdf in frames:
            out = []
            for path in pdf["path"]:
                store, name = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
                with store.open_input_file(name) as f, tarfile.open(fileobj=f, mode="r:") as t:
                    for m in t:
                        if m.isfile() and m.name.lower().endswith(ends) and not m.name.startswith("/") and ".." not in m.name.split("/"):
                            out.append((path, m.name))
            yield pd.DataFrame(out, columns=["path", "member"])

    return raw_files(spark, root, [".tar"], prune).select("path").mapInPandas(members, "path string, member string")


def raw_videos(spark: SparkSession, root: str, suffixes: list[str]) -> DataFrame:
    """(raw_type, raw_path, raw_member_path) of files and of members of tar files, in order; meta/ and data/stageN_* are left out."""
    files = raw_files(spark, root, suffixes, prune=True).select(F.lit("file").alias("raw_type"), F.col("path").alias("raw_path"), F.lit("").alias("raw_member_path"))
    inside = tar_members(spark, root, suffixes, prune=True).select(F.lit("tar").alias("raw_type"), F.col("path").alias("raw_path"), F.col("member").alias("raw_member_path"))
    return files.union(inside).orderBy("raw_path", "raw_member_path")


@contextlib.contextmanager
def localised(path: str, member: str, folder: str | None = None):
    """A path that tools can open, for use in a provider's task: the file itself, or a member of a tar file, copied out and deleted afterwards."""
    import os
    import shutil
    import tarfile
    import tempfile

    if not member:
        yield path
        return
    with tempfile.TemporaryDirectory(dir=folder) as own:
        out = os.path.join(own, os.path.basename(member))
        with tarfile.open(path, mode="r:") as t, open(out, "wb") as f:
            if (source := t.extractfile(member)) is None:
                raise FileNotFoundError(f"{member} is no file of {path}")
            shutil.copyfileobj(source, f)
        yield out
