"""Resolution, duration and frame arithmetic of training buckets."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def pixel_budget(height: int) -> int:
    """Pixels of a 16:9 picture of this height."""
    return int(round(height * height * 16 / 9))


def bucket_resolution(width: Column, height: Column, budget: int, multiple: int, upscale: bool = False) -> Column:
    """struct<width, height>: scaled to the budget, both sides floored to a multiple; null for sides that vanish or are not positive."""
    w, h = width.cast("double"), height.cast("double")
    pixels = w * h
    factor = F.sqrt(F.lit(float(budget)) / pixels)
    scale = factor if upscale else F.when(pixels > budget, factor).otherwise(1.0)
    side = lambda x: (F.floor(x * scale / multiple) * multiple).cast("int")
    good = (width > 0) & (height > 0)
    return F.when(good & (side(w) > 0) & (side(h) > 0), F.struct(side(w).alias("width"), side(h).alias("height")))


def frame_buckets(frames: list[int], stride: int) -> list[int]:
    """Frame counts of the form k * stride + 1, distinct and ascending."""
    return sorted({(f - 1) // stride * stride + 1 for f in frames if f >= 1})


def bucket_frames(duration: Column, fps: Column, buckets: list[int]) -> Column:
    """The largest bucket that the clip fills; null if it fills none."""
    have = F.floor(duration * fps + 1e-9)
    return F.array_max(F.filter(F.array(*map(F.lit, sorted(buckets))), lambda b: b <= have))


def dynamic_batch(base: int, reference_cost: float, cost: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.lit(float(base)) * reference_cost / cost)).cast("int")


def even_size(width: Column, height: Column, short_side: int) -> Column:
    """struct<width, height> with the short side scaled, both even."""
    k = F.lit(float(short_side)) / F.least(width, height)
    even = lambda x: (F.rint(x * k / 2) * 2).cast("int")
    return F.struct(even(width).alias("width"), even(height).alias("height"))


def centre_crop(width: Column, height: Column, ratio: float) -> Column:
    """struct<x, y, width, height>: the largest centred window of this aspect ratio."""
    wide = width > height * ratio
    w = F.greatest(F.lit(1), F.when(wide, F.floor(height * ratio)).otherwise(width)).cast("int")
    h = F.greatest(F.lit(1), F.when(wide, height).otherwise(F.floor(width / ratio))).cast("int")
    return F.struct(F.floor((width - w) / 2).cast("int").alias("x"), F.floor((height - h) / 2).cast("int").alias("y"), w.alias("width"), h.alias("height"))


def uniform_pick(items: Column, k: int) -> Column:
    """k elements at evenly spread places, half-even rounded; elements repeat in shorter arrays, an empty array gives none."""
    n = F.size(items)
    if k == 1:
        return F.when(n > 0, F.slice(items, 1, 1)).otherwise(items)
    places = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.rint(i * (n - 1) / F.lit(float(k - 1))).cast("int"))
    return F.when(n > 0, F.transform(places, lambda p: items[p])).otherwise(items)


def encoder_pick(items: Column, k: int, stride: int = 4) -> Column:
    """uniform_pick() for an encoder: fewer than `stride` missing elements are repeated, more of them are an error."""
    short = F.lit(k) - F.size(items)
    return F.when(short >= stride, F.raise_error(F.format_string(f"%d of {k} frames missing", short))).otherwise(uniform_pick(items, k))


def steps_column(rows: Column, world: int, batch: int) -> Column:
    """steps_per_epoch() of a column."""
    return F.greatest(F.lit(1).cast("long"), F.ceil(rows / F.lit(float(world * batch))).cast("long"))


def steps_per_epoch(rows: int, world: int, batch: int) -> int:
    return max(1, math.ceil(rows / (world * batch)))


def uniform_timestamps(frames: Column, fps: Column, duration: Column) -> Column:
    """Seconds of each frame, no later than the duration, to six places."""
    return F.when(frames > 0, F.transform(F.sequence(F.lit(0), frames - 1), lambda i: F.round(F.least(i / fps, duration), 6))).otherwise(F.array().cast("array<double>"))


def padded_timestamps(seconds: Column, n: int) -> Column:
    """The first n seconds, to six places, filled up with -1."""
    return F.slice(F.concat(F.transform(seconds, lambda s: F.round(s, 6)), F.array_repeat(F.lit(-1.0), n)), 1, n)
