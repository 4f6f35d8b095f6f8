"""Declarative rule sets compiled to columns, with reject reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """A test of one field: missing, then equals, then min, then max; bounds are inclusive."""

    name: str
    field: str
    equals: object = None
    min: float | None = None
    max: float | None = None
    reject_reason: str | None = None
    min_reject_reason: str | None = None
    max_reject_reason: str | None = None
    missing_reject_reason: str | None = None

    def __post_init__(self) -> None:
        if self.equals is None and self.min is None and self.max is None:
            raise ValueError(f"rule {self.name} has no bound")
        if self.reject_reason is None:
            if self.equals is not None:
                raise ValueError(f"rule {self.name} needs reject_reason")
            if self.min is not None and self.min_reject_reason is None or self.max is not None and self.max_reject_reason is None:
                raise ValueError(f"rule {self.name} needs a reason for each bound")

    def reason(self, value: Column) -> Column:
        """The reason why the value fails, null if it passes. NaN passes bounds, as no comparison holds for it."""
        missing = self.missing_reject_reason or self.reject_reason or self.min_reject_reason or self.max_reject_reason
        out = F.when(value.isNull(), F.lit(missing))
        if self.equals is not None:
            out = out.when(value != F.lit(self.equals), F.lit(self.reject_reason))
        number = value.cast("double")
        if self.min is not None:
            out = out.when(~F.isnan(number) & (number < F.lit(float(self.min))), F.lit(self.min_reject_reason or self.reject_reason))
        if self.max is not None:
            out = out.when(~F.isnan(number) & (number > F.lit(float(self.max))), F.lit(self.max_reject_reason or self.reject_reason))
        return out


def resolve_field(df: DataFrame, path: str, kind: str = "double") -> Column:
    """A column, a struct's field or a JSON text's value by dotted path; null where it is missing or malformed."""
    name, *rest = path.split(".")
    if not name or not all(rest):
        raise ValueError(f"empty part in field path {path!r}")
    column, dtype = F.col(f"`{name}`"), df.schema[name].dataType
    while rest and isinstance(dtype, T.StructType):
        dtype = dtype[rest[0]].dataType
        column = column.getField(rest.pop(0))
    if not rest:
        return column
    return F.try_variant_get(F.try_parse_json(column), "$." + ".".join(rest), kind)


def json_error(df: DataFrame, column: str) -> Column:
    """Text of a row error if the JSON column is there but malformed, else null."""
    return F.when(F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull(), F.lit(f"malformed JSON in {column}"))


def check(df: DataFrame, rules: list[Rule], prefix: str = "rules") -> DataFrame:
    """df with <prefix>_pass (1 or 0) and <prefix>_reject_reason: all failing rules' reasons in rule order, joined by `;`."""
    reasons = F.array(*[r.reason(resolve_field(df, r.field)) for r in rules])
    joined = F.array_join(F.filter(reasons, lambda r: r.isNotNull()), ";")
    return df.withColumn(f"{prefix}_reject_reason", joined).withColumn(f"{prefix}_pass", (F.col(f"{prefix}_reject_reason") == "").cast("long"))


# The rules that screen raw videos.
SCREEN_RULES = [
    Rule("probe", "probe_ok", equals=1, reject_reason="probe_failed"),
    Rule("short_side", "short_side", min=360, reject_reason="resolution_too_low"),
    Rule("fps", "fps", min=20.0, reject_reason="fps_too_low"),
    Rule("duration", "duration_sec", min=1.0, max=600.0, min_reject_reason="duration_too_short", max_reject_reason="duration_too_long"),
]


def short_side(width: Column, height: Column) -> Column:
    """The smaller side, null if either is."""
    return F.when(width.isNotNull() & height.isNotNull(), F.least(width, height))


def cached(ok: Column, file: Column, sizes: list[Column] | None = None, shape: Column | None = None) -> Column:
    """Whether a packaged row is complete: ok is 1, its file is named, all sizes are positive and the shape is a JSON list that is not empty."""
    out = F.coalesce(ok.try_cast("long") == 1, F.lit(False)) & (F.coalesce(F.trim(file), F.lit("")) != "")
    for s in sizes or []:
        out = out & F.coalesce(s.try_cast("long") > 0, F.lit(False))
    if shape is not None:
        parsed = F.try_parse_json(shape)
        out = out & F.coalesce(F.schema_of_variant(parsed).startswith("ARRAY") & (F.get_json_object(shape, "$[0]").isNotNull()), F.lit(False))
    return out


def usable(path: Column, ok: Column | None = None) -> Column:
    """Whether a row has a path and, where there is an ok flag, that is 1."""
    named = F.coalesce(F.trim(path), F.lit("")) != ""
    return named if ok is None else named & F.coalesce(ok.try_cast("long") == 1, F.lit(False))


def context_complete(frames: Column, audio_ok: Column, audio: Column) -> Column:
    """Whether a context row names frames and, where its audio is ok, audio files; both are JSON objects with lists of paths."""
    some = lambda text, name: F.coalesce(F.size(F.from_json(F.get_json_object(text, f"$.{name}"), "array<string>")) > 0, F.lit(False))
    return some(frames, "frame_paths") & (~audio_ok.try_cast("long").eqNullSafe(F.lit(1)) | some(audio, "audio_paths"))


def first_reason(*cases: tuple[Column, str]) -> Column:
    """The reason of the first case that holds; null if none does."""
    return F.coalesce(*[F.when(condition, F.lit(reason)) for condition, reason in cases])


def threshold_filter(df: DataFrame, **bounds: tuple[str, float]) -> DataFrame:
    """Rows whose columns keep every strict bound ("lt" or "gt", number); a missing or NaN value matches none."""
    keep = F.lit(True)
    for name, (side, bound) in bounds.items():
        v = F.col(name).try_cast("double")
        keep = keep & F.coalesce(~F.isnan(v) & ((v < bound) if side == "lt" else (v > bound)), F.lit(False))
    return df.where(keep)


def keyword_filter(df: DataFrame, keyword: str, columns: list[str]) -> DataFrame:
    """Rows in which some of the columns contains the keyword, whatever the case."""
    keep = F.lit(False)
    for c in columns:
        keep = keep | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(keyword.lower())), F.lit(False))
    return df.where(keep)
