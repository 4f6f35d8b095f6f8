"""Frames of a clip: change scores, one frame per time bin, temporal indices, box coverage."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scales import exact_round, interpolated, linear_decay, linear_growth, trapezoid_scale


def content_change(df: DataFrame, key: str, order: str, weights: dict[str, float]) -> DataFrame:
    """df with `change`: weighted mean distance of the channels from the frame before, 0 for the first frame."""
    total = sum(map(abs, weights.values()))
    if not total:
        raise ValueError("at least one weight must not be zero")
    w = Window.partitionBy(key).orderBy(order)
    change = F.lit(0.0)
    for name, weight in weights.items():
        change = change + F.abs(F.col(name) - F.lag(name).over(w)) * weight
    return df.withColumn("change", F.round(F.coalesce(change / total, F.lit(0.0)), 6))


def pick_per_bin(frames: Column, duration: Column, fps: float) -> Column:
    """Indices of one frame for each 1/fps seconds, ascending: the highest score in the bin, then the lowest index.

    `frames` is an array of struct<index, at, score>, by index. A bin without a frame that is still free takes
    the free one nearest to its centre; bins end when all frames are taken. The fold keeps the indices taken.
    """
    eps, step = 1e-6, 1.0 / fps
    bins = F.greatest(F.lit(1), F.ceil((duration - eps) / step)).cast("int")

    def take(taken: Column, i: Column) -> Column:
        start, end = i * F.lit(step), F.least((i + 1) * F.lit(step), duration)
        free = F.filter(frames, lambda f: ~F.array_contains(taken, f["index"]))
        inside = F.filter(free, lambda f: (f["at"] >= start - eps) & (f["at"] < end - eps))
        best = F.array_max(F.transform(inside, lambda f: F.struct(f["score"].alias("s"), (-f["index"]).alias("i"))))
        nearest = F.array_min(F.transform(free, lambda f: F.struct(F.abs(f["at"] - (start + end) / 2).alias("s"), f["index"].alias("i"))))
        chosen = F.coalesce(-best["i"], nearest["i"])
        return F.when(chosen.isNotNull(), F.array_append(taken, chosen)).otherwise(taken)

    return F.array_sort(F.aggregate(F.sequence(F.lit(0), bins - 1), F.array().cast("array<int>"), take))


def _spread(start: Column, stop: Column, n: Column, low: Column, high: Column) -> Column:
    """n evenly spaced numbers from start to stop, clipped to [low, high], cut to integers."""
    gap = F.when(n > 1, (stop - start) / (n - 1)).otherwise(0.0)
    value = lambda i: F.when((i == n - 1) & (n > 1), stop).otherwise(start + i * gap)
    clip = lambda i: F.least(F.greatest(value(i).cast("double"), low.cast("double")), high.cast("double")).cast("long")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), clip)).otherwise(F.array().cast("array<long>"))


def frame_step(frames_per_clip: int, video_fps: float, duration: float | None = None, fps: int | None = None) -> int:
    """Frames between samples, from a clip's duration or from the wanted rate (exactly one of them)."""
    if (duration is None) == (fps is None) or video_fps <= 0:
        raise ValueError("one of duration and fps, and a positive video rate")
    step = int(duration * math.ceil(video_fps) / frames_per_clip) if duration is not None else math.ceil(video_fps) // fps
    if step <= 0:
        raise ValueError("frame step must be positive")
    return step


def clip_indices(total: Column, frames_per_clip: int, step: int, clips: int, overlap: bool = False, shift=None) -> Column:
    """array<array<long>> of the frames of each training clip.

    The video is cut into equal parts, one a clip. A part longer than a clip gives its first frames, or those from
    shift(clip, room) on, 0 <= shift < room, as random_shift() gives them; a shorter one is sampled and padded with its
    last frame, or, if clips may overlap, clips start at even steps.
    """
    length = frames_per_clip * step
    part = F.floor(total / clips).cast("int")
    whole = lambda c: F.transform(_spread(F.lit(0), F.lit(length), F.lit(frames_per_clip), F.lit(0), F.lit(length - 1)), lambda x: x + c * part + (F.lit(0) if shift is None else shift(c, part - length)))

    def padded(span: Column, shift) -> Column:
        n = F.floor(span / step).cast("int")
        sampled = _spread(F.lit(0), span, n, F.lit(0), span - 1)
        return F.transform(F.concat(sampled, F.array_repeat((span - 1).cast("long"), F.greatest(F.lit(0), F.lit(frames_per_clip) - n))), lambda x: x + shift)

    span = F.least(F.lit(length), total) - 1
    hop = F.when((total > length) & F.lit(clips > 1), F.floor((total - length) / max(1, clips - 1))).otherwise(0)
    one = lambda c: F.when(part > length, whole(c)).otherwise(padded(span, c * hop) if overlap else padded(part, c * part))
    return F.transform(F.sequence(F.lit(0), F.lit(clips - 1)), one)


def random_shift(key: Column, seed: int):
    """A repeatable offset for each key and clip, for clip_indices()."""
    return lambda clip, room: F.when(room > 0, F.pmod(F.xxhash64(key, clip, F.lit(seed)), room.cast("long"))).otherwise(F.lit(0).cast("long"))


def optical_scores(
    df: DataFrame, key: str, brightness: str, dark: str, bright: str, contrast: str, q: float = 0.2,
    brightness_scale: tuple = (0.05, 0.20, 0.80, 0.95), dark_scale: tuple = (0.05, 0.50), bright_scale: tuple = (0.05, 0.50), contrast_scale: tuple = (0.05, 0.25),
) -> DataFrame:
    """(key, exposure, contrast, optical, and medians of the four inputs) from rows of frames.

    A frame's exposure is the product of scaled brightness and scaled shares of too dark and too bright pixels; both
    scores are the quantile q over frames, to six places (exact_round), and the optical score is their product. A clip's frames meet in
    one array, as an exact quantile needs them all.
    """
    exposure = trapezoid_scale(F.col(brightness), *brightness_scale) * linear_decay(F.col(dark), *dark_scale) * linear_decay(F.col(bright), *bright_scale)
    rows = df.select(F.col(key), exposure.alias("__e"), linear_growth(F.col(contrast), *contrast_scale).alias("__c"), *[F.col(c).alias(f"__m{i}") for i, c in enumerate((brightness, dark, bright, contrast))])
    exact = lambda c, p: exact_round(interpolated(F.collect_list(c), p), 6)
    out = rows.groupBy(key).agg(exact("__e", q).alias("exposure"), exact("__c", q).alias("contrast"), *[exact(f"__m{i}", 0.5).alias(n) for i, n in enumerate(("brightness", "too_dark", "too_bright", "dynamic_range"))])
    return out.withColumn("optical", exact_round(F.col("exposure") * F.col("contrast"), 6))


@F.pandas_udf(T.DoubleType())
def polygon_share(polygons: pd.Series, scores: pd.Series, width: pd.Series, height: pd.Series, least: pd.Series) -> pd.Series:
    """Share of a picture's pixels in the union of polygons (lists of x, y, x, y, ...) of a score of `least` or more.

    Corners are rounded to pixels; four numbers are a box of two corners; fewer than three corners cover nothing. A pixel
    is covered if it lies in a polygon or on its outline.
    """
    out = []
    for shapes, weights, w, h, bound in zip(polygons, scores, width, height, least):
        grid = np.zeros((int(h), int(w)), bool)
        for shape, weight in zip(shapes if shapes is not None else [], weights if weights is not None else []):
            p = np.asarray(shape, float)
            if weight < bound or len(p) % 2:
                continue
            p = np.array([[p[0], p[1]], [p[2], p[1]], [p[2], p[3]], [p[0], p[3]]]) if len(p) == 4 else p.reshape(-1, 2)
            p = np.rint(p).astype(int)
            if len(p) < 3:
                continue
            a, b = p, np.roll(p, -1, axis=0)
            for y in range(max(0, p[:, 1].min()), min(int(h) - 1, p[:, 1].max()) + 1):
                # where edges cross the row of pixels; edges that end in it count with their lower end only
                cross = (a[:, 1] <= y) != (b[:, 1] <= y)
                x = np.sort(a[cross, 0] + (y - a[cross, 1]) * (b[cross, 0] - a[cross, 0]) / (b[cross, 1] - a[cross, 1]))
                for left, right in zip(x[::2], x[1::2]):
                    grid[y, max(0, int(np.ceil(left - 0.5))) : max(0, int(np.floor(right + 0.5)) + 1)] = True
                for (x0, y0), (x1, y1) in zip(a, b):  # corners, and edges along the row
                    if y0 == y and 0 <= x0 < int(w):
                        grid[y, x0] = True
                    if y0 == y1 == y:
                        grid[y, max(0, min(x0, x1)) : max(0, max(x0, x1) + 1)] = True
        out.append(float(grid.mean()) if grid.size else None)
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def covered_share(boxes: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Share of a picture covered by the union of axis-parallel boxes (x0, y0, x1, y1), clipped to it."""
    out = []
    for own, w, h in zip(boxes, width, height):
        b = np.clip(np.array([list(x) for x in own], float).reshape(-1, 4), 0, [w, h, w, h]) if own is not None else np.zeros((0, 4))
        xs, ys = np.unique(b[:, [0, 2]]), np.unique(b[:, [1, 3]])
        grid = np.zeros((max(0, len(xs) - 1), max(0, len(ys) - 1)), bool)
        for x0, y0, x1, y1 in b:
            grid[np.searchsorted(xs, x0) : np.searchsorted(xs, x1), np.searchsorted(ys, y0) : np.searchsorted(ys, y1)] = True
        area = (np.diff(xs)[:, None] * np.diff(ys)[None] * grid).sum() if grid.size else 0.0
        out.append(float(area / (w * h)) if w and h else None)
    return pd.Series(out)
