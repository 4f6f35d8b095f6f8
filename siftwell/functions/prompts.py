"""Prompt and message texts from structured columns; configuration coercions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import frame_timeline


def section(title: str, body: Column) -> Column:
    """A titled block, or null where the body is blank, so that concat_ws drops it."""
    return F.when(F.coalesce(F.trim(body), F.lit("")) != "", F.concat(F.lit(f"{title}:\n"), body))


def build_prompt(instruction: str, seconds: Column, **context: Column) -> Column:
    """Instruction, frame timeline, then the context sections in the order given; blank ones are left out."""
    parts = [F.lit(instruction), section("Frames", frame_timeline(seconds))]
    parts += [section(name.replace("_", " ").capitalize(), body) for name, body in context.items()]
    return F.concat_ws("\n\n", *parts)


def camera_prompt(instruction: str, seconds: Column) -> Column:
    """Asks for camera labels from frames alone."""
    return build_prompt(instruction, seconds)


def tag_prompt(instruction: str, seconds: Column, camera: Column) -> Column:
    """Asks for tags from frames and camera labels."""
    return build_prompt(instruction, seconds, camera_labels=camera)


def caption_prompt(instruction: str, seconds: Column, transcript: Column, camera: Column, tags: Column) -> Column:
    """Asks for captions from frames, what is heard, camera labels and tags; blank parts are left out."""
    return build_prompt(instruction, seconds, audio_transcript=transcript, camera_labels=camera, tags=tags)


def label_lines(labels: Column, names: list[str]) -> Column:
    """`name: value` lines of a struct of labels; list values are comma-joined, null ones unknown."""
    line = lambda n: F.concat(F.lit(f"{n}: "), F.coalesce(labels[n].cast("string"), F.lit("unknown")))
    return F.concat_ws("\n", *[line(n) for n in names])


def coerce_bool(value: Column) -> Column:
    v = F.lower(F.trim(value.cast("string")))
    return F.when(v.isin("1", "true", "yes", "on"), True).when(v.isin("0", "false", "no", "off", "", "null", "none"), False)


def coerce_number(value: Column, default: float | None = None) -> Column:
    """A number, the default where the text is none or not finite."""
    v = value.try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(default)).otherwise(F.coalesce(v, F.lit(default)))


def coerce_names(value: Column) -> Column:
    """A JSON list of names, or one name, as an array."""
    parsed = F.from_json(value, "array<string>")
    return F.when(F.trim(value).startswith("["), F.coalesce(parsed, F.array().cast("array<string>"))).when(F.coalesce(F.trim(value), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(value))


def coerce_optional(value: Column) -> Column:
    """Trimmed text; null if it is blank or `null`."""
    v = F.trim(value.cast("string"))
    return F.when((v != "") & (F.lower(v) != "null"), v)
