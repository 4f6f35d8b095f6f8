"""Feature store: one row a clip with its codes or vectors, and counts that a reader checks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shards import _fs


def save_features(df: DataFrame, path: str, values: str, kind: str, version: str) -> dict:
    """Writes (clip_id, ok, error, `values` array, ...) with the size of each row's array and metadata.json; returns the metadata."""
    spark = df.sparkSession
    rows = df.withColumn("value_count", F.greatest(F.lit(0), F.coalesce(F.size(values), F.lit(0))))
    rows.write.mode("overwrite").parquet(f"{path}/features")
    n = spark.read.parquet(f"{path}/features").agg(F.count("*").alias("clips"), F.coalesce(F.sum("value_count"), F.lit(0)).alias("values")).first()
    metadata = {"kind": kind, "version": version, "values": values, "clip_count": n["clips"], "value_count": n["values"]}
    fs, p = _fs(spark, f"{path}/metadata.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(metadata, sort_keys=True, indent=2).encode()))
    out.close()
    return metadata


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a feature store; other numbers of clips or values than its metadata and rows state are an error."""
    metadata = json.loads("\n".join(r.value for r in spark.read.option("wholetext", "true").text(f"{path}/metadata.json").collect()))
    df = spark.read.parquet(f"{path}/features")
    held = F.greatest(F.lit(0), F.coalesce(F.size(metadata["values"]), F.lit(0)))
    n = df.agg(F.count("*").alias("clips"), F.coalesce(F.sum(held), F.lit(0)).alias("values"), F.count_if(held != F.col("value_count")).alias("odd")).first()
    if (n["clips"], n["values"], n["odd"]) != (metadata["clip_count"], metadata["value_count"], 0):
        raise ValueError(f"{path} holds {n['values']} values of {n['clips']} clips, its metadata say {metadata['value_count']} of {metadata['clip_count']}")
    return df
