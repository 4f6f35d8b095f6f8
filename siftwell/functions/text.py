"""Identifiers, paths and prompt text."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .repair import clean_prompt
from .scales import exact_round

__all__ = [
    "blake_id", "bucketed_path", "cache_path", "clean_prompt", "clip_id", "collapse_blanks", "component_spec", "frame_timeline", "human_bytes",
    "human_seconds", "join_relative", "replace_component", "safe_file_name", "strip_prefix_path",
]


def clip_id(video: Column, clip: Column, split: Column) -> Column:
    return F.format_string("%s:clip:%05d:%02d", video, clip, split)


def bucketed_path(key: Column, root: str = "") -> Column:
    """root/ab/cd/key with the first digits of the key's SHA-1."""
    digest = F.sha1(key)
    parts = [F.substring(digest, 1, 2), F.substring(digest, 3, 2), key]
    return F.concat_ws("/", *([F.lit(root)] if root else []), *parts)


def safe_file_name(name: Column, fallback: str = "item") -> Column:
    cleaned = F.trim(F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), F.lit("._-"))
    return F.when(F.coalesce(cleaned, F.lit("")) == "", F.lit(fallback)).otherwise(cleaned)


def strip_prefix_path(path: Column, root: str) -> Column:
    return F.when(path.startswith(root.rstrip("/") + "/"), F.substr(path, F.lit(len(root.rstrip("/")) + 2))).otherwise(path)


def join_relative(root: str, path: Column) -> Column:
    return F.when(path.startswith("/"), F.raise_error(F.concat(F.lit("absolute path: "), path))).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


@F.pandas_udf(T.StringType())
def blake_id(source: pd.Series, batch: pd.Series, path: pd.Series, member: pd.Series) -> pd.Series:
    """video- and 64 bits of BLAKE2b over source, batch, path and, if there is one, member; Spark has no such digest."""
    out = []
    for parts in zip(source, batch, path, member):
        text = "\n".join(p for p in parts if p)
        out.append("video-" + hashlib.blake2b(text.encode(), digest_size=8).hexdigest())
    return pd.Series(out)


def collapse_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def frame_timeline(seconds: Column) -> Column:
    """One line a frame; unknown (negative) seconds say so."""
    line = lambda t, i: F.when(t >= 0, F.format_string("- frame_%04d: %.3fs", i, t)).otherwise(F.format_string("- frame_%04d: unknown", i))
    return F.array_join(F.transform(seconds, line), "\n")


def human_bytes(n: Column) -> Column:
    """Whole bytes below 1024, else two decimals of KB, MB, GB, TB or PB (powers of 1024); `-` if null, NaN or negative."""
    out = F.format_string("%d B", n.cast("long"))
    for power, unit in enumerate(("KB", "MB", "GB", "TB", "PB"), 1):
        out = F.when(n >= float(1024**power), F.format_string(f"%.2f {unit}", exact_round(n.cast("double") / float(1024**power), 2))).otherwise(out)
    return F.when(n.isNull() | F.isnan(n.cast("double")) | (n < 0), "-").otherwise(out)


def human_seconds(s: Column) -> Column:
    """`12.3s`, `4m 05s` or `2h 03m`; `-` if null, NaN or negative."""
    v = s.cast("double")
    whole = lambda x: F.floor(x).cast("long")
    minutes = F.format_string("%dm %02ds", whole(v / 60), F.rint(v % 60).cast("long"))
    hours = F.format_string("%dh %02dm", whole(v / 3600), whole((v % 3600) / 60))
    return F.when(v.isNull() | F.isnan(v) | (v < 0), "-").when(v < 60, F.format_string("%.1fs", exact_round(v, 1))).when(v < 3600, minutes).otherwise(hours)


def replace_component(path: Column, old: str, new: str) -> Column:
    """The path with every whole component `old` replaced; names that only contain it stay."""
    return F.array_join(F.transform(F.split(path, "/"), lambda p: F.when(p == old, F.lit(new)).otherwise(p)), "/")


def cache_path(clip: Column, frames: Column, width: Column, height: Column, root: str = "") -> Column:
    """root/{T}f/{W}x{H}/ab/cd/<safe clip id>-<12 digits of its SHA-1>.meta; sizes that are not positive are an error."""
    name = F.concat(safe_file_name(clip, "clip"), F.lit("-"), F.substring(F.sha1(clip), 1, 12), F.lit(".meta"))
    path = F.concat_ws("/", *([F.lit(root)] if root else []), F.format_string("%df", frames), F.format_string("%dx%d", width, height), bucketed_path(name))
    return F.when((frames > 0) & (width > 0) & (height > 0), path).otherwise(F.raise_error(F.lit("frames, width and height must be positive")))


def component_spec(spec: str) -> dict[str, int]:
    """`select_pass=1,count=10` as a dict: exactly these two keys, once each; select_pass is 0 or 1, count positive."""
    pairs = [tuple(x.strip() for x in part.partition("=")[::2]) if "=" in part else (part.strip(), "") for part in spec.split(",")]
    fields = dict(pairs)
    if len(fields) < len(pairs) or set(fields) != {"select_pass", "count"} or not all(v.lstrip("+-").isdigit() for v in fields.values()):
        raise ValueError(f"a component is select_pass=0 or 1 and count=n, not {spec!r}")
    out = {k: int(v) for k, v in fields.items()}
    if out["select_pass"] not in (0, 1) or out["count"] <= 0:
        raise ValueError(f"select_pass must be 0 or 1 and count positive in {spec!r}")
    return out
