"""Output folders: commits as a whole, resets, lists of ids, runs and their shards."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shards import _fs


def commit_folder(spark: SparkSession, path: str, write: Callable[[str], object], overwrite: bool = False):
    """Calls write(folder) with a folder beside the target, which then becomes the target; returns what write returns.

    A target that is there is an error without overwrite, before anything is written. It is moved aside and deleted only when
    the new one is in place; a failure leaves it as it was.
    """
    fs, target = _fs(spark, path.rstrip("/"))
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if fs.exists(target) and not overwrite:
        raise FileExistsError(path)
    tag = uuid.uuid4().hex
    own, aside = (Path(target.getParent(), f".{target.getName()}.{kind}-{tag}") for kind in ("tmp", "old"))
    try:
        out = write(own.toString())
        if fs.exists(target):
            fs.rename(target, aside)
        if not fs.rename(own, target):
            raise OSError(f"{path} could not be put in place")
    except Exception:
        if fs.exists(aside) and not fs.exists(target):
            fs.rename(aside, target)
        fs.delete(own, True)
        raise
    fs.delete(aside, True)
    return out


def reset_output(spark: SparkSession, path: str, resume: bool) -> None:
    """Makes a dataset's folder ready: metadata goes always; without resume also folders named WxH or Tf and unfinished files."""
    fs, root = _fs(spark, path.rstrip("/"))
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(root)
    fs.delete(Path(root, "metadata.json"), True)
    fs.delete(Path(root, "shards"), True)
    if resume:
        return
    for s in fs.listStatus(root):
        if s.isDirectory() and re.fullmatch(r"\d+x\d+|\d+f", s.getPath().getName()):
            fs.delete(s.getPath(), True)
    files = fs.listFiles(root, True)
    while files.hasNext():
        p = files.next().getPath()
        if p.getName().endswith(".meta.tmp"):
            fs.delete(p, False)


def write_id_lists(df: DataFrame, path: str, order: str, clip: str = "clip_id", video: str = "video_id") -> None:
    """<path>/clip_ids.txt in order, and <path>/video_ids.txt, sorted and distinct; both are folders of text files."""
    df.orderBy(order).select(F.col(clip).cast("string")).write.mode("overwrite").text(f"{path}/clip_ids.txt")
    df.select(F.col(video).cast("string")).distinct().orderBy(video).write.mode("overwrite").text(f"{path}/video_ids.txt")


def run_ids(spark: SparkSession, base: str) -> list[str]:
    """Ids of the runs below a folder, newest (largest) first; folders may be named run_id=<id> or <id>."""
    fs, root = _fs(spark, base)
    if not fs.exists(root):
        return []
    return sorted((s.getPath().getName().removeprefix("run_id=") for s in fs.listStatus(root) if s.isDirectory()), reverse=True)


def run_path(spark: SparkSession, base: str, run_id: str) -> str:
    fs, old = _fs(spark, f"{base.rstrip('/')}/run_id={run_id}")
    return old.toString() if fs.exists(old) else f"{base.rstrip('/')}/{run_id}"


def summary_shards(spark: SparkSession, root: str, summary: dict, unit: str) -> list[str]:
    """Paths of the shards that a summary names and that are there; if none are, those of the unit by name."""
    fs, folder = _fs(spark, root)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    named = [s.get("path") for s in summary.get("shards") or [] if isinstance(s, dict) and s.get("path")]
    found = [p for n in named if fs.exists(p := Path(folder, n)) and fs.getFileStatus(p).isFile()]
    if not found and fs.exists(folder):
        found = sorted((s.getPath() for s in fs.listStatus(folder) if re.fullmatch(rf"{re.escape(unit)}-.*\.parquet", s.getPath().getName())), key=lambda p: p.getName())
    return [p.toString() for p in found]
