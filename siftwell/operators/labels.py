"""Structured labels: JSON objects against closed domains, counts, fallbacks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_object(text: Column, salvage: bool = False) -> Column:
    """The object's text, null if it is none; salvage takes what stands between the first { and the last }."""
    raw = F.regexp_extract(text, r"(?s)\{.*\}", 0) if salvage else text
    kind = F.schema_of_variant(F.try_parse_json(raw))
    return F.when(kind.startswith("OBJECT"), raw)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value worked out once a row, however often it is used; branches of a condition share nothing otherwise."""
    return F.transform(F.array(value), then)[0]


@dataclass(frozen=True)
class LabelSchema:
    """Single fields with their values; groups of such; list fields with their values and those that stand alone; free text fields; fields of one fixed value."""

    single: dict[str, list[str]] = field(default_factory=dict)
    multi: dict[str, list[str]] = field(default_factory=dict)
    exclusive: tuple[str, ...] = ("none", "unknown")
    free: tuple[str, ...] = ()
    groups: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    fixed: dict[str, str] = field(default_factory=dict)

    def ddl(self) -> str:
        parts = [f"`{k}`:string" for k in (*self.single, *self.free, *self.fixed)]
        parts += [f"`{g}`:struct<" + ",".join(f"`{k}`:string" for k in fields) + ">" for g, fields in self.groups.items()]
        parts += [f"`{k}`:array<string>" for k in self.multi]
        return "struct<" + ", ".join(parts) + ">"

    def fields(self) -> list[str]:
        return [*self.single, *self.free, *self.fixed, *self.groups, *self.multi]

    def error(self, text: Column) -> Column:
        """Why the label text is invalid, null if it is valid."""
        return _once(self._read(text), self._error)

    def _read(self, text: Column) -> Column:
        """struct of the object, its values and keys, and the keys of its groups: the text is parsed once for each of these."""

        def parts(obj: Column) -> Column:
            own = [F.json_object_keys(F.get_json_object(obj, f"$.{g}")).alias(f"keys_{g}") for g in self.groups]
            return F.struct(obj.alias("obj"), F.from_json(obj, self.ddl()).alias("value"), F.json_object_keys(obj).alias("keys"), *own)

        return _once(json_object(text), parts)

    def _error(self, read: Column) -> Column:
        value, keys = read["value"], read["keys"]
        names = lambda keys: F.array(*map(F.lit, keys))
        out = F.when(read["obj"].isNull(), F.lit("not an object"))
        known = names(self.fields())
        out = out.when(F.size(F.array_except(keys, known)) > 0, F.lit("unknown field")).when(F.size(F.array_except(known, keys)) > 0, F.lit("missing field"))
        for k, domain in self.single.items():
            out = out.when(value[k].isNull() | ~value[k].isin(domain), F.lit(f"bad {k}"))
        for k in self.free:
            out = out.when(value[k].isNull(), F.lit(f"bad {k}"))
        for k, only in self.fixed.items():
            out = out.when(~value[k].eqNullSafe(F.lit(only)), F.lit(f"bad {k}"))
        for g, fields in self.groups.items():
            own, inside = read[f"keys_{g}"], names(fields)
            out = out.when(own.isNull() | (F.size(F.array_except(own, inside)) > 0) | (F.size(F.array_except(inside, own)) > 0), F.lit(f"bad {g}"))
            for k, domain in fields.items():
                out = out.when(value[g][k].isNull() | ~value[g][k].isin(domain), F.lit(f"bad {g}.{k}"))
        for k, domain in self.multi.items():
            v = F.array_distinct(value[k])
            out = out.when(v.isNull() | (F.size(v) == 0) | F.exists(v, lambda x: x.isNull()) | (F.size(F.array_except(v, names(domain))) > 0), F.lit(f"bad {k}"))
            out = out.when((F.size(v) > 1) & F.arrays_overlap(v, names(self.exclusive)), F.lit(f"{k} mixes an exclusive value"))
        return out

    def parse(self, text: Column) -> Column:
        """struct of the labels, list values distinct; the fallback (all `unknown`, free fields blank) where invalid."""
        return self.checked(text)["labels"]

    def checked(self, text: Column) -> Column:
        """struct of error() as `error` and parse() as `labels`, from one reading of the text."""

        def both(read: Column) -> Column:
            return _once(
                F.struct(read["value"].alias("value"), self._error(read).alias("error")),
                lambda r: F.struct(r["error"].alias("error"), self._labels(r["value"], r["error"].isNull()).alias("labels")),
            )

        return _once(self._read(text), both)

    def _labels(self, value: Column, ok: Column) -> Column:
        one = lambda v, k: F.when(ok, v).otherwise(F.lit("unknown")).alias(k)
        cols = [one(value[k], k) for k in self.single]
        cols += [F.when(ok, value[k]).otherwise(F.lit("")).alias(k) for k in self.free]
        cols += [F.lit(only).alias(k) for k, only in self.fixed.items()]
        cols += [F.struct(*[one(value[g][k], k) for k in fields]).alias(g) for g, fields in self.groups.items()]
        cols += [F.when(ok, F.array_distinct(value[k])).otherwise(F.array(F.lit("unknown"))).alias(k) for k in self.multi]
        return F.struct(*cols)

    def flat(self, labels: Column, prefix: str) -> list[Column]:
        """A column <prefix>_<field> for each field of parsed labels; fields of groups as <prefix>_<group>_<field>."""
        out = [labels[k].alias(f"{prefix}_{k}") for k in (*self.single, *self.free, *self.fixed)]
        out += [labels[g][k].alias(f"{prefix}_{g}_{k}") for g, fields in self.groups.items() for k in fields]
        return out + [labels[k].alias(f"{prefix}_{k}") for k in self.multi]

    def domains(self) -> list[tuple[str, str]]:
        """All (field, label) of closed fields, fields of groups as group.field."""
        out = [(k, v) for k, values in (*self.single.items(), *self.multi.items()) for v in values]
        return out + [(f"{g}.{k}", v) for g, fields in self.groups.items() for k, values in fields.items() for v in values]


# The labels of camera work.
CAMERA = LabelSchema(
    single={
        "motion_type": ["no-motion", "minor-motion", "simple-motion", "complex-motion", "unknown"],
        "steadiness": ["static", "no-shaking", "minimal-shaking", "unsteady", "very-unsteady", "unknown"],
        "speed": ["slow", "regular", "fast", "unknown"],
        "scene_dynamics": ["static", "mostly-static", "dynamic", "unknown"],
    },
    groups={
        "rotation": {
            "pan": ["pan-left", "pan-right", "no-pan", "unknown"],
            "tilt": ["tilt-up", "tilt-down", "no-tilt", "unknown"],
            "roll": ["roll-CW", "roll-CCW", "no-roll", "unknown"],
        },
        "translation": {
            "dolly": ["dolly-in", "dolly-out", "no-dolly", "unknown"],
            "pedestal": ["pedestal-up", "pedestal-down", "no-pedestal", "unknown"],
            "truck": ["truck-left", "truck-right", "no-truck", "unknown"],
        },
        "intrinsic": {"zoom": ["zoom-in", "zoom-out", "no-zoom", "unknown"]},
        "object_centric": {
            "arc": ["arc-CW", "arc-CCW", "no-arc", "unknown"],
            "arc_tracking": ["arc-tracking", "no-arc-tracking", "unknown"],
            "lead_tracking": ["lead-tracking", "no-lead-tracking", "unknown"],
            "tail_tracking": ["tail-tracking", "no-tail-tracking", "unknown"],
            "side_tracking": ["side-tracking", "no-side-tracking", "unknown"],
            "aerial_tracking": ["aerial-tracking", "no-aerial-tracking", "unknown"],
            "pan_tracking": ["pan-tracking", "no-pan-tracking", "unknown"],
            "tilt_tracking": ["tilt-tracking", "no-tilt-tracking", "unknown"],
            "subject_size_change": ["subject-larger", "subject-smaller", "no-subject-change", "unknown"],
        },
    },
    multi={"effects": ["frame-freezing", "dolly-zoom", "motion-blur", "none", "unknown"]},
)
# The versions that a model's structured answer on camera work has to name.
CAMERA_OUTPUT = replace(CAMERA, fixed={"label_version": "camera_v1", "prompt_version": "camera_qa_v1"})
# The tags of clips.
TAG = LabelSchema(
    single={
        "domain": ["real_world", "animation", "game", "screen_recording", "synthetic_render", "mixed", "unknown"],
        "scene": ["general_indoor", "general_outdoor", "urban", "nature", "driving", "sports", "food", "product", "portrait", "screen", "other", "unknown"],
        "style": ["photorealistic", "cinematic", "documentary", "anime", "cartoon", "cg_render", "gameplay", "graphic", "unknown"],
        "text": ["none", "incidental", "subtitle", "screen_ui", "document", "signage", "overlay_text", "unknown"],
        "watermark": ["none", "logo", "text_watermark", "platform_watermark", "unknown"],
    },
    multi={
        "subjects": ["person", "vehicle", "animal", "object", "food", "landscape", "building", "text", "screen", "robot", "other", "unknown"],
        "actions": ["talking", "locomotion", "driving", "sports", "cooking", "object_manipulation", "natural_motion", "camera_motion_only", "timelapse", "none", "other", "unknown"],
    },
)
# The four levels of captions.
CAPTION = LabelSchema(free=("level_3", "level_2", "level_1", "level_0"))


def all_label_counts(df: DataFrame, labels: Column, schema: LabelSchema) -> DataFrame:
    """(field, label, n, percent) for every closed field of a schema and every label of its domain, from one scan; percent of all rows."""
    one = lambda name, v: F.struct(F.lit(name).alias("field"), v.alias("label"))
    found = [F.array(*[one(k, labels[k]) for k in schema.single], *[one(f"{g}.{k}", labels[g][k]) for g, fields in schema.groups.items() for k in fields])]
    named = lambda name: lambda v: one(name, v)
    found += [F.transform(F.array_distinct(labels[k]), named(k)) for k in schema.multi]
    counted = df.select(F.explode(F.concat(*found)).alias("x")).groupBy("x.field", "x.label").agg(F.count("*").alias("n"))
    names = df.sparkSession.createDataFrame(schema.domains(), "field string, label string")
    out = names.join(counted, ["field", "label"], "left").join(F.broadcast(df.agg(F.count("*").alias("total"))))  # one row
    n = F.coalesce("n", F.lit(0)).cast("long")
    return out.select("field", "label", n.alias("n"), F.round(100.0 * n / F.greatest("total", F.lit(1)), 2).alias("percent"))


def label_counts(df: DataFrame, values: Column, domain: list[str]) -> DataFrame:
    """(label, n, percent) for every label of the domain, in order of count, then label; percent of all rows, to two places."""
    spark = df.sparkSession
    counted = df.select(F.explode(F.array_distinct(values)).alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    names = spark.createDataFrame([(d,) for d in domain], "label string")
    out = names.join(counted, "label", "left").join(F.broadcast(total))  # one row
    n = F.coalesce("n", F.lit(0)).cast("long")
    return out.select("label", n.alias("n"), F.round(100.0 * n / F.greatest("total", F.lit(1)), 2).alias("percent")).orderBy(F.desc("n"), "label")
