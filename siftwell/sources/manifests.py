"""A training manifest from a split: ids in order, their rows, their files."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import ordered_fetch
from ..operators.sampling import manifest_lines
from .outputs import commit_folder
from .shards import unit_summary, write_manifest, write_summary, write_unit


def existing_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(path, length) of all files below some folders, without the scheme of local paths; no file is read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
    return df.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length")


def with_file(rows: DataFrame, path_col: str, files: DataFrame, name: str = "file_ok") -> DataFrame:
    """rows with `name`: whether the path is that of a file which is not empty. Files (path, length) are listed once; null and blank paths are none."""
    there = files.where("length > 0").select(F.col("path").alias("__path"), F.lit(True).alias("__there")).distinct()
    own = F.regexp_replace(F.trim(F.col(path_col)), "^file:/+", "/")
    return rows.join(there, own == F.col("__path"), "left").withColumn(name, F.coalesce("__there", F.lit(False))).drop("__path", "__there")


def manifest_from_split(
    ids: DataFrame, rows: DataFrame, path: str, path_col: str = "clip_path", label: int = 0, name: str = "train.csv", id_col: str = "clip_id", video_col: str = "video_id",
    position: str = "position", rows_per_shard: int = 500_000, overwrite: bool = False, files: DataFrame | None = None,
) -> dict:
    """Writes a folder with the manifest (path and label a line, in the order of ids), the ids, the rows as shards and summary.json; returns the summary.

    ids has id_col and a position; rows are usable ones, where those of one id agree in their path. An id without a row, an id twice, a path with
    white space and, with `files` (path, length), a path of no file are errors; then nothing is left behind. The folder appears as a whole.
    """
    if "/" in name or not name.endswith(".csv"):
        raise ValueError("a manifest is a .csv file")
    if rows_per_shard <= 0:
        raise ValueError("rows_per_shard must be positive")
    spark = ids.sparkSession
    if twice := ids.groupBy(id_col).count().where("count > 1").limit(1).collect():
        raise ValueError(f"{twice[0][0]} is listed twice")
    chosen = ordered_fetch(rows, ids.select(id_col, position), id_col, position, same=path_col)
    if files is not None:
        gone = [r[0] for r in with_file(chosen, path_col, files, "__file").where("not __file").select(path_col).limit(10).collect()]
        if gone:
            raise FileNotFoundError(f"no files: {gone}")
    target = f"{path.rstrip('/')}/{name}"

    def write(folder: str) -> dict:
        lines = chosen.select(F.col(path_col).alias("p"), F.lit(str(int(label))).alias("l"), position).orderBy(position)
        n = write_manifest(manifest_lines(lines, "p", "l"), f"{folder}/{name}")
        out = chosen.withColumns({"manifest_ok": F.lit(1).cast("long"), "manifest_video_path": F.col(path_col), "manifest_path": F.lit(target)}).drop(position)
        seen = write_unit(out, folder, "clip", rows_per_shard)
        chosen.orderBy(position).select(F.col(id_col).cast("string")).write.text(f"{folder}/clip_ids.txt")
        shards = unit_summary(spark, folder, "clip")
        if not n == seen["rows"] == shards["total_rows"]:
            raise RuntimeError(f"{n} lines, {seen['rows']} rows")
        videos = spark.read.option("pathGlobFilter", "clip-*.parquet").parquet(folder).agg(F.count_distinct(video_col)).first()[0]
        summary = {
            "created_at": datetime.now(tz=UTC).isoformat(), "manifest_name": name, "manifest_path": target, "label": int(label), "row_count": n,
            "unique_video_id_count": videos, "parquet_size": rows_per_shard, "check_files": files is not None, "parquet": shards,
        }
        write_summary(spark, folder, summary)
        return summary

    return commit_folder(spark, path, write, overwrite)


def listed_ids(spark: SparkSession, path: str, id_col: str = "clip_id", position: str = "position") -> DataFrame:
    """(id_col, position) of the lines of a text file in its order, blank ones left out."""
    rows = spark.read.text(path).select(F.trim("value").alias(id_col), F.monotonically_increasing_id().alias(position))
    return rows.where(F.col(id_col) != "")
