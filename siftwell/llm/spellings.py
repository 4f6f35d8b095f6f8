"""Spelling variants: words one error apart, grouped under their frequent forms.

Two words are near if one inserted, deleted or replaced character tells them apart. The error lies in the first or in
the second half of the shorter word, so one half is shared exactly. Words are dealt to tasks by their first and by their
last characters. A task makes a minimal acyclic automaton of its words, read forward or backward, whose states know
how many words lie below: a path through it adds up to the word's number, with which counts and words are looked up.
Each word is matched exactly through one half there and completed with one error beyond it.

No pair is found twice. The place of an error is where the two words part, counted from the front (for a run of equal
characters behind its last); places in the second half are found forward, those in the first half backward. What
leaves a task is one row for each word with near ones, not one for each pair.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, shuffle_partitions, slices, stored

#: Shortest words; halves of at least 3 and 4 characters deal them.
SHORTEST, HEAD, TAIL = 7, 3, 4
#: Words of one key up to which a task takes them together; words of an automaton, up to the end of a key.
CROWD, CHUNK = 40_000, 40_000
#: Different words that a counting task holds before it passes them on.
HELD = 200_000


def count_words(df: DataFrame, every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of whole texts and how often they stand there.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, of which one in `every` (0: none), drawn
    from the crc32 of id and word, loses a character; those shorter than SHORTEST are left out. Null texts have
    none, a null id counts as empty, repeated rows count again. Other columns do not matter. An empty table gives no rows.
    """
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % SHORTEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def rows() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])

        for b in slices(batches):
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                # one byte a code point; what lies above U+00FF is no letter here, nor is its stand-in
                start = zlib.crc32(f"{i}:".encode())
                for w, n in Counter(runs.findall(text.encode("latin-1", "replace").lower())).items():
                    if every:
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if h % every == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1 :]
                            if len(w) < SHORTEST:
                                continue
                    total[w] = total.get(w, 0) + n
                if len(total) > HELD:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    texts = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return in_arrow(texts.where("text is not null"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Automaton:
    """The minimal acyclic automaton of words, given in order; a word's number is its place in that order.

    arcs[s] maps a character to (state, words before those that it leads to); `last` are the states in which words end.
    """

    def __init__(self, words: list[bytes]) -> None:
        self.arcs: list[dict[int, tuple[int, int]]] = []
        self.below: list[int] = []
        self.last: list[bool] = []
        known: dict[tuple, int] = {}
        # states of the last word's path, not merged yet: whether a word ends there, and arcs to merged states
        path: list[tuple[bool, list]] = [(False, [])]
        before = b""

        def merged(state: tuple[bool, list]) -> int:
            key = (state[0], *state[1])
            found = known.get(key)
            if found is None:
                found = known[key] = len(self.arcs)
                n, out = int(state[0]), {}
                for c, to in state[1]:
                    out[c] = (to, n)
                    n += self.below[to]
                self.arcs.append(out)
                self.below.append(n)
                self.last.append(state[0])
            return found

        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            while len(path) > shared + 1:
                to = merged(path.pop())
                path[-1][1].append((before[len(path) - 1], to))
            for at in range(shared + 1, len(word) + 1):
                path.append((at == len(word), []))
            before = word
        while len(path) > 1:
            to = merged(path.pop())
            path[-1][1].append((before[len(path) - 1], to))
        self.start = merged(path.pop())

    def number(self, word: bytes, state: int | None = None, n: int = 0) -> int:
        """The number of the word that `word` completes from a state on, -1 if there is none; n: words before it so far."""
        s, arcs = self.start if state is None else state, self.arcs
        for c in word:
            arc = arcs[s].get(c)
            if arc is None:
                return -1
            s = arc[0]
            n += arc[1]
        return n if self.last[s] else -1

    def one_error(self, word: bytes, replaced: range, inserted: range, backward: bool) -> tuple[list[int], list[int]]:
        """Numbers of words with one character of `word` replaced, and with one inserted, at these places; the rest is matched exactly.

        Of equal words that insertions at several places make, only that of the last place is taken (backward: the first).
        """
        s, n, arcs = self.start, 0, self.arcs
        begin = min(replaced.start, inserted.start)
        for c in word[:begin]:
            arc = arcs[s].get(c)
            if arc is None:
                return [], []
            s, n = arc[0], n + arc[1]
        other, longer = [], []
        for at in range(begin, max(replaced.stop, inserted.stop)):
            here = word[at] if at < len(word) else -1
            twin = (word[at - 1] if at else -1) if backward else here
            rest = word[at:]
            for c, (to, off) in arcs[s].items():
                if at in replaced and c != here and (found := self.number(rest[1:], to, n + off)) >= 0:
                    other.append(found)
                if at in inserted and c != twin and (found := self.number(rest, to, n + off)) >= 0:
                    longer.append(found)
            arc = arcs[s].get(here)
            if arc is None:
                break
            s, n = arc[0], n + arc[1]
        return other, longer


def near_words(words: list[bytes], counts: list[int], back: bool, m: int, lo: int, hi: int) -> Iterator[tuple[bytes, int, int, bytes]]:
    """(word, near words found, count of the best one, that word) for different words, by errors at places lo to hi of words of length m.

    m = 0: of each word of any length the places of its second half, or of its first if `back`. The best near word is that of the
    largest count, ties to the smaller word.
    """
    keyed = sorted((w[::-1], w, n) for w, n in zip(words, counts)) if back else sorted((w, w, n) for w, n in zip(words, counts))
    automaton = Automaton([k for k, _, _ in keyed])
    n_near, best = [0] * len(keyed), [(0, b"")] * len(keyed)

    def met(a: int, b: int) -> None:
        n_near[a] += 1
        _, w, n = keyed[b]
        if n > best[a][0] or (n == best[a][0] and w < best[a][1]):
            best[a] = (n, w)

    for i, (key, _, _) in enumerate(keyed):
        size = len(key)
        if m and size != m:  # the longer ones are found only
            continue
        if not m:
            lo, hi = (0, size // 2) if back else (size // 2, size + 1)
        replaced = range(size - hi, size - lo) if back else range(lo, min(hi, size))
        inserted = range(size - hi + 1, size - lo + 1) if back else range(lo, hi)
        other, longer = automaton.one_error(key, replaced, inserted, back)
        for j in other:
            met(i, j)
        for j in longer:
            met(i, j)
            met(j, i)
    for (_, w, _), n, (most, at) in zip(keyed, n_near, best):
        if n:
            yield w, n, most, at


def _dealt(words: DataFrame) -> DataFrame:
    """Each word under its first characters, to be read forward, and its last ones, to be read backward."""
    whole = [F.lit(0).alias(c) for c in ("m", "lo", "hi")]
    sides = F.array(F.struct(F.lit(False).alias("back"), F.substring("word", 1, HEAD).alias("key")), F.struct(F.lit(True).alias("back"), F.substring("word", -TAIL, TAIL).alias("key")))
    return words.select("word", "n", F.explode(sides).alias("x"), *whole).select("word", "n", "x.back", "m", "lo", "hi", "x.key")


def _split(dealt: DataFrame) -> DataFrame:
    """Crowded keys dealt again, exactly: by length, then each range of places in halves, with all that words share outside the range."""
    size = F.length("word")
    lengths = F.explode(F.when(F.col("m") > 0, F.array(F.col("m"))).otherwise(F.filter(F.array(size, size - 1), lambda x: x >= SHORTEST)))
    rows = dealt.select("word", "n", "back", F.col("m").alias("was"), "lo", "hi", lengths.alias("m"))
    half = lambda a, b: F.struct(a.cast("int").alias("lo"), b.cast("int").alias("hi"))
    middle = F.floor((F.col("lo") + F.col("hi")) / 2)
    first = F.when(F.col("back"), half(F.lit(0), F.floor(F.col("m") / 2))).otherwise(half(F.floor(F.col("m") / 2), F.col("m") + 1))
    ranges = F.when(F.col("was") == 0, F.array(first)).otherwise(F.array(half(F.col("lo"), middle), half(middle, F.col("hi"))))
    rows = rows.select("word", "n", "back", "m", F.explode(ranges).alias("r")).select("word", "n", "back", "m", "r.lo", "r.hi")
    behind: Column = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    key = F.concat(F.substring(F.col("word"), F.lit(1), F.col("lo")), F.lit("|"), F.when(behind > 0, F.substring(F.col("word"), -behind, behind)).otherwise(""))
    return rows.select("word", "n", "back", "m", "lo", "hi", key.alias("key"))


def _near(words: DataFrame, crowd: int, chunk: int) -> DataFrame:
    """(word, n_near, best struct(m, form)) rows to be summed up, from different words (word, n)."""
    keys = ["back", "m", "lo", "hi", "key"]
    left, ready = _dealt(words), None
    while True:
        # a range of one place holds no more words than there are characters, so keys stop being crowded
        sizes = left.groupBy(*keys).agg(F.count("*").alias("size")).where((F.col("size") > crowd) & ((F.col("m") == 0) | (F.col("hi") - F.col("lo") > 1)))
        crowded, _ = stored(sizes.select(*keys))
        if crowded.isEmpty():
            break
        ready = left.join(crowded, keys, "left_anti") if ready is None else ready.unionByName(left.join(crowded, keys, "left_anti"))
        left = _split(left.join(crowded, keys, "left_semi"))
    rows = left if ready is None else ready.unionByName(left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        counts: list[int] = []
        kind, key = None, None

        def found() -> Iterator[pa.RecordBatch]:
            out = list(near_words(held, counts, *kind))
            held.clear()
            counts.clear()
            if out:
                w, n, most, form = zip(*out)
                text = lambda x: pa.array([v.decode("latin-1") for v in x], pa.string())
                yield pa.RecordBatch.from_arrays([text(w), pa.array(n, pa.int64()), pa.array(most, pa.int64()), text(form)], names=["word", "n_near", "most", "form"])

        for b in batches:
            for w, n, *own, k in zip(*(b.column(i).to_pylist() for i in range(7))):
                own = tuple(own)
                if (own, k) != (kind, key):
                    if held and (own != kind or len(held) >= chunk):
                        yield from found()
                    kind, key = own, k
                held.append(w.encode("latin-1"))
                counts.append(n)
        if held:
            yield from found()

    parts = shuffle_partitions(words.sparkSession)
    placed = rows.select("word", "n", *keys).repartition(parts, *keys).sortWithinPartitions(*keys)
    out = in_arrow(placed, run, "word string, n_near long, most long, form string")
    return out.select("word", "n_near", F.struct(-F.col("most"), F.col("form")).alias("best"))


def spelling_groups(words: DataFrame, least: int = 2, times: int = 10, crowd: int = CROWD, chunk: int = CHUNK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n) with at least `least` occurrences and SHORTEST characters.

    n_near counts the near words among these; form is the near word of largest n, ties to the smaller word in code-point order, if that n is at
    least `times` (2 or more) the word's, else null with form_n. root is where forms lead from the word in the end, the word itself without one.
    Words of characters above U+00FF are none of the texts' and are left out, as null words and counts are; rows of one word are summed up.
    """
    words = words.where(~F.col("word").rlike("[^\\u0000-\\u00FF]")).groupBy("word").agg(F.sum("n").alias("n"))
    words, _ = stored(words.where((F.col("n") >= least) & (F.length("word") >= SHORTEST)))
    none = F.lit(None).cast("struct<most: bigint, form: string>")
    rows = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("best"))
    rows = rows.union(_near(words, crowd, chunk).select("word", F.lit(None).cast("long"), "n_near", "best"))
    found = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    most = -F.col("best.most")
    has = F.coalesce(most >= times * F.col("n"), F.lit(False))
    found, _ = stored(found.select("word", F.when(has, F.col("best.form")).alias("form"), "n", "n_near", F.when(has, most).alias("form_n")))
    ends, _ = stored(found.where("form is not null").select("word", F.col("form").alias("root")))
    while True:  # the way to the root halves each time, and a form has `times` its word's count
        then = ends.select(F.col("word").alias("via"), F.col("root").alias("next"))
        ends, _ = stored(ends.join(then, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if ends.where("moved").isEmpty():
            break
        ends = ends.drop("moved")
    return found.join(ends.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
