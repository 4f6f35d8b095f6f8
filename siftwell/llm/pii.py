"""Personal data: pattern spans, and terms that give protected entities away.

Native throughout. Base spans come from patterns (email, ip, card, phone). The protected entities are the values of
these spans and credentials: runs of KEY or more letters and digits that hold both. For an entity c and a term t of
the texts that name it, co-occurrence estimates the pointwise mutual information log2 p(c | t) / p(c); it reaches
the entity's information content -log2 p(c) where the term alone tells who is meant. As most entities occur in a
text or two, p(c | t) is smoothed: (n_both + 1/2) / (n_term + 1), so that a term seen once, with the entity, is
not taken as certain to tell it. Terms whose share of the information content exceeds a threshold are spans of
kind `term`: generalised to a placeholder, or removed where they disclose (nearly) everything. A share of 0.9 is
reached by terms that leave no more than about N ** 0.1 of N texts to choose from.

Entities of the very same texts disclose alike, so they are one class: a text with many values of its own gives
one pair with each of its words, not one for each value.

Patterns start with "not behind a character of the first class, or where the last match ended": the matches are
those of the plain patterns, leftmost first, but a long run of such characters is read once and not once for
each of its characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import removed, stored

KINDS = ["email", "ip", "card", "phone", "term"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text holds if it may hold a match at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"[\p{L}\p{N}]++"
PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
#: A credential: letters and digits in one run of KEY or more.
KEY = 20
CREDENTIAL = rf"(?<![\p{{L}}\p{{N}}])(?=\p{{L}}*+\p{{N}})(?=\p{{N}}*+\p{{L}})[\p{{L}}\p{{N}}]{{{KEY},}}+"
#: Terms of texts up to which they are broadcast.
SMALL = 100_000
SPAN = "array<struct<start:int,kind:int,stop:int,word:string>>"


def spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """array<struct<start, kind, stop, word>> of the pattern's matches, in code points; keep(word) drops some."""
    words = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)  # one more than matches, so the last pair has no word
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(a: Column, x: Column) -> Column:
        begin = a["at"] + F.char_length(x["gap"])
        stop = begin + F.char_length(x["word"])
        one = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), x["word"].alias("word"))
        kept = x["word"].isNotNull() if keep is None else F.coalesce(keep(x["word"]), F.lit(False))
        return F.struct(stop.alias("at"), F.when(kept, F.array_append(a["out"], one)).otherwise(a["out"]).alias("out"))

    zipped = F.zip_with(between, words, lambda g, w: F.struct(g.alias("gap"), w.alias("word")))
    return F.aggregate(zipped, start, add, lambda a: a["out"])


def luhn(digits: Column) -> Column:
    n = F.char_length(digits)
    at = F.sequence(F.lit(1), n)
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    value = lambda i: digits.substr(i, F.lit(1)).cast("int")
    return F.aggregate(at, F.lit(0), lambda s, i: s + F.when((n - i) % 2 == 1, doubled(value(i))).otherwise(value(i))) % 10 == 0


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def _card(word: Column) -> Column:
    d = _digits(word)
    return F.when(F.char_length(d).between(14, 19), luhn(d)).otherwise(False)


def _ip(word: Column) -> Column:
    return word.rlike(rf"\A{PART}\.{PART}\.{PART}\.{PART}\z")


def _phone(word: Column) -> Column:
    return F.char_length(_digits(word)).between(10, 15)


CHECKS = {"email": None, "ip": _ip, "card": _card, "phone": _phone}


def base_spans(text: Column) -> Column:
    """All base spans of a text, sorted by start, then kind."""
    none = F.array().cast(SPAN)
    found = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        may = text.rlike(r"[0-9]") if HINTS[kind] is None else text.contains(HINTS[kind])
        found.append(F.when(may & text.rlike(pattern), spans(text, pattern, i, CHECKS[kind])).otherwise(none))
    return F.array_sort(F.concat(*found))


def credentials(text: Column) -> Column:
    """The different credentials of a text, lower-cased."""
    none = F.array().cast("array<string>")
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(CREDENTIAL), F.lit(0)))
    return F.when(text.rlike(f"[\\p{{L}}\\p{{N}}]{{{KEY}}}"), found).otherwise(none)


def entities(text: Column, found: Column) -> Column:
    """Names of a text's protected entities: kind and value of its base spans, and its credentials."""
    named = F.transform(found, lambda s: F.concat(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), F.lit(":"), F.lower(s["word"])))
    return F.array_distinct(F.concat(named, F.transform(credentials(text), lambda c: F.concat(F.lit("key:"), c))))


def outside(text: Column, found: Column) -> Column:
    """The text with a blank for each of its base spans."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(a: Column, s: Column) -> Column:
        gap = F.when(s["start"] > a["at"], F.array_append(a["out"], text.substr(a["at"] + 1, s["start"] - a["at"]))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), gap.alias("out"))

    rest = F.aggregate(found, start, add, lambda a: F.concat_ws(" ", a["out"], text.substr(a["at"] + 1, F.char_length(text))))
    return F.when(F.size(found) > 0, rest).otherwise(text)


def disclosing_terms(held: DataFrame, texts: DataFrame, share: float = 0.9, support: int = 1) -> DataFrame:
    """(digest, term, weight): by text, the terms that disclose an entity which the text names.

    `held` has a row (digest, text, spans) for each row that names an entity, `texts` every text. weight is the
    smoothed PMI of term and entity over the entity's information content, by counts of rows; terms of a weight over
    `share` that stand with the entity in at least `support` distinct texts are returned. A credential is a term that
    discloses itself, with weight 1. Parts of an entity's value count only where they stand outside base spans.
    """
    named = held.select("digest", F.explode(entities(F.col("text"), F.col("spans"))).alias("entity")).groupBy("digest", "entity").agg(F.count("*").alias("copies"))
    named, _ = stored(named)
    if named.isEmpty():
        return named.select("digest", F.lit("").alias("term"), F.lit(0.0).alias("weight")).limit(0)
    # entities of the very same texts are one class, named by their number and two hashes over them
    alike = named.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("texts"), F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64(F.reverse("digest"))).alias("y"))
    classes = alike.where(F.col("texts") >= support).select("entity", "n_entity", F.struct("texts", "x", "y").alias("class"))
    classed, _ = stored(named.join(classes, "entity").select("digest", "class", "copies", "n_entity").distinct())
    often = classed.select("class", "n_entity").distinct()
    words = F.array_distinct(F.regexp_extract_all(F.lower(outside(F.col("text"), F.col("spans"))), F.lit(TERM), F.lit(0)))
    # one row a text and word: copies meet here, before words meet entities
    terms = held.select("digest", F.explode(words).alias("term")).distinct()
    joint = terms.join(classed.drop("n_entity"), "digest").groupBy("class", "term").agg(F.sum("copies").alias("n_both"), F.count("*").alias("texts"))
    joint, joint_at = stored(joint.where(F.col("texts") >= support).drop("texts"))
    # words are counted by task before they are shuffled; a word within a span counts for its text too
    spread = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    everywhere = texts.select(F.explode(spread).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    n = float(texts.count())
    content = -F.log2(F.col("n_entity") / F.lit(n))
    # a word that some span cuts from a longer run may be counted less often everywhere than with the entity
    told = joint.join(everywhere, "term", "left").join(often, "class").withColumn("n_term", F.greatest("n_term", "n_both"))
    pmi = F.log2((F.col("n_both") + 0.5) / (F.col("n_term") + 1)) + content
    told = told.withColumn("weight", F.when(content > 0, pmi / content).otherwise(0.0)).where(F.col("weight") > share)
    # what is told is stored: its shuffles go before words are dealt to texts again, and pairs that tell nothing go too
    told, _ = stored(told.select("class", "term", "weight"))
    removed(held.sparkSession, joint_at)
    by_text = told.join(classed, "class").join(terms, ["digest", "term"]).select("digest", "term", "weight")
    own = held.select("digest", F.explode(credentials(F.col("text"))).alias("term"), F.lit(1.0).alias("weight"))
    return by_text.union(own).groupBy("digest", "term").agg(F.max("weight").alias("weight"))


def find_personal_data(df: DataFrame, share: float = 0.9, support: int = 1, text_col: str = "text", spans_col: str = "spans", weights_col: str = "weights") -> DataFrame:
    """df with `spans_col` (sorted array of start, kind, stop, word) and `weights_col` (term to weight, null if the text names no entity).

    A null text counts as empty and has no spans; every row of a repeated text has the same spans; empty
    tables and other columns pass (columns of these two names are replaced). Only texts that name an entity are
    stored and shuffled; all others are read, counted and passed on.
    """
    rows = df.drop(spans_col, weights_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = base_spans(text)
    names = (F.size(base) > 0) | text.rlike(CREDENTIAL)
    # columns are named by their places, and the text is stored once
    every = F.struct(*[F.col(f"`{c}`").alias(f"{i}") for i, c in enumerate(rows.columns)]).alias("row")
    held, _ = stored(rows.where(names).select(every, F.md5(text).alias("digest"), base.alias("spans")))
    at = [c.lower() for c in rows.columns].index(text_col.strip("`").lower())
    held = held.withColumn("text", F.coalesce(F.col(f"row.`{at}`").cast("string"), F.lit("")))
    terms = disclosing_terms(held.select("digest", "text", "spans"), df.select(text.alias("text")), share, support)
    by_text, _ = stored(terms.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("weights")))
    # at most SMALL short arrays are broadcast; more of them are joined with a shuffle of the texts that are held
    few = (by_text.select(F.size("weights").alias("n")).agg(F.sum("n")).first()[0] or 0) <= SMALL
    out = held.join(F.broadcast(by_text) if few else by_text, "digest", "left")
    none = F.array().cast(SPAN)
    found = F.when(F.col("weights").isNotNull(), spans(F.col("text"), TERM, 4, lambda w: F.map_contains_key("weights", F.lower(w)))).otherwise(none)
    out = out.withColumn("found", found)
    apart = F.filter("found", lambda t: ~F.exists("spans", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    # the row's own columns come last, as they may have any name
    marked = out.select("row", F.array_sort(F.concat("spans", apart)).alias("spans"), "weights")
    told = marked.select(*[F.col(f"row.`{i}`") for i in range(len(rows.columns))], F.col("spans").alias("s"), F.col("weights").alias("w")).toDF(*rows.columns, spans_col, weights_col)
    rest = rows.where(~names).select("*", none.alias(spans_col), F.lit(None).cast("map<string,double>").alias(weights_col))
    return told.union(rest)


def sanitised(text: Column, found: Column, weights: Column, remove: float = 0.975) -> Column:
    """The text with a placeholder for each span; terms of a weight of `remove` or more are left out."""
    names = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(i), F.lit(PLACEHOLDERS[k]))])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(a: Column, s: Column) -> Column:
        gone = F.coalesce((s["kind"] == 4) & (F.try_element_at(weights, F.lower(s["word"])) >= remove), F.lit(False))
        new = F.concat(text.substr(a["at"] + 1, s["start"] - a["at"]), F.when(gone, F.lit("")).otherwise(names[s["kind"]]))
        # a span that begins within the one before has no placeholder of its own
        out = F.when(s["start"] >= a["at"], F.array_append(a["out"], new)).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), out.alias("out"))

    whole = F.aggregate(found, start, add, lambda a: F.concat(F.array_join(a["out"], ""), text.substr(a["at"] + 1, F.char_length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)


def span_list(found: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["stop"])), ",")
