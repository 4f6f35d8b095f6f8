"""Dataset metadata as JSON shards with an index, and manifests of split ids."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import metadata_shards
from .shards import _fs


def write_metadata(df: DataFrame, path: str, id_col: str, rows_per_shard: int) -> list[str]:
    """Writes shards/metadata-NNNNNN.json, JSON lists of consecutive rows by id, and metadata.json, which names them.

    A shard is one row of bounded size while it is built; files are written by the executors and renamed when
    all are there.
    """
    spark = df.sparkSession
    items = metadata_shards(df, id_col, rows_per_shard)
    lists = items.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct(F.col(id_col).alias("__key"), F.struct(*df.columns).alias("item")))).alias("items"))
    text = lists.select("shard", F.to_json(F.transform("items", lambda x: x["item"]), {"ignoreNullFields": "false"}).alias("value"))
    root = path.rstrip("/")
    text.write.mode("overwrite").partitionBy("shard").text(f"{root}/_staging")
    fs, shards = _fs(spark, f"{root}/shards")
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.delete(shards, True)
    fs.mkdirs(shards)
    names = []
    for s in fs.listStatus(Path(f"{root}/_staging")):
        if (name := s.getPath().getName()).startswith("shard="):
            target = f"shards/metadata-{int(name.removeprefix('shard=')):06d}.json"
            (part,) = [p.getPath() for p in fs.listStatus(s.getPath()) if p.getPath().getName().startswith("part-")]
            fs.rename(part, Path(f"{root}/{target}"))
            names.append(target)
    fs.delete(Path(f"{root}/_staging"), True)
    out = fs.create(Path(f"{root}/metadata.json"), True)
    out.write(bytearray(json.dumps({"shards": sorted(names)}).encode()))
    out.close()
    return sorted(names)


def read_metadata(spark: SparkSession, path: str, schema=None, required: list[str] | None = None, limit: int | None = None, shard_col: str | None = None) -> DataFrame:
    """Items of the shards that metadata.json names, up to the limit; an item without a required value is an error. shard_col: a column for the shard's file name."""
    root = path.rstrip("/")
    names = json.loads("".join(r.value for r in spark.read.text(f"{root}/metadata.json").collect()))["shards"]
    reader = spark.read.option("multiLine", "true")
    if schema is not None:
        reader = reader.schema(schema)
    items = reader.json([f"{root}/{n}" for n in names])
    if shard_col:
        items = items.withColumn(shard_col, F.col("_metadata.file_name"))
    for name in required or []:
        bad = F.coalesce(F.trim(F.col(name).cast("string")), F.lit("")) == ""
        items = items.withColumn(name, F.when(bad, F.raise_error(F.lit(f"an item without {name}"))).otherwise(F.col(name)))
    return items if limit is None else items.limit(max(0, limit))


def dataset_problems(items: DataFrame, required: list[str], positive: list[str]) -> DataFrame:
    """(column, missing, invalid) for columns that must be there and those that must be positive numbers, from one scan."""
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    checks = [F.struct(F.lit(c).alias("column"), blank(c).alias("m"), F.lit(False).alias("i")) for c in required]
    checks += [F.struct(F.lit(c).alias("column"), blank(c).alias("m"), (~blank(c) & ~F.coalesce(F.col(c).try_cast("double") > 0, F.lit(False))).alias("i")) for c in positive]
    rows = items.select(F.explode(F.array(*checks)).alias("x")).select("x.*")
    return rows.groupBy("column").agg(F.count_if("m").alias("missing"), F.count_if("i").alias("invalid"))


def dataset_scan(items: DataFrame, frames: str, resolution: str, source: str, caption: str) -> DataFrame:
    """Counts by frames, resolution, both and source in one pass, with caption lengths: (level, frames, resolution, source, n, captions, mean_caption)."""
    rows = items.select(F.col(frames).alias("frames"), F.col(resolution).alias("resolution"), F.col(source).alias("source"), F.char_length(F.nullif(F.trim(F.col(caption)), F.lit(""))).alias("len"))
    f, r, s = F.col("frames"), F.col("resolution"), F.col("source")
    return rows.groupingSets([[f], [r], [f, r], [s]], f, r, s).agg(
        F.grouping_id("frames", "resolution", "source").cast("int").alias("level"), F.count("*").alias("n"), F.count("len").alias("captions"), F.round(F.avg("len"), 3).alias("mean_caption")
    )


def dataset_parts(items: DataFrame, valid: Column, **columns: str) -> DataFrame:
    """(kind, value, rows, valid_rows, invalid_rows) for every value of some columns, such as shard, latent shape and source resolution; one pass. Nulls are values."""
    names = [f"__{k}" for k in columns]
    rows = items.select(*[F.col(c).cast("string").alias(n) for n, c in zip(names, columns.values())], F.coalesce(valid, F.lit(False)).alias("__ok"))
    sets = rows.groupingSets([[F.col(n)] for n in names], *map(F.col, names))
    out = sets.agg(F.grouping_id(*names).alias("g"), F.count("*").alias("rows"), F.count_if("__ok").alias("valid_rows"))
    own = lambda i: (1 << len(names)) - 1 - (1 << (len(names) - 1 - i))
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (k, n) in enumerate(zip(columns, names)):
        kind, value = F.when(F.col("g") == own(i), k).otherwise(kind), F.when(F.col("g") == own(i), F.col(n)).otherwise(value)
    return out.select(kind.alias("kind"), value.alias("value"), "rows", "valid_rows", (F.col("rows") - F.col("valid_rows")).alias("invalid_rows"))


def mixed_batches(items: DataFrame, batch: str, bucket: str) -> DataFrame:
    """Batches that hold more than one bucket, which a loader must refuse."""
    return items.groupBy(batch).agg(F.count_distinct(bucket).alias("buckets")).where("buckets > 1")
