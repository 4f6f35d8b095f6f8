"""Fill-in-middle and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from siftwell.llm import fim, queries, spellings

ODD = "doc_id long, text string, n int, form string, word int, best string, ab int, fim_id int, fim_of string"


@pytest.fixture(scope="module")
def odd(spark):
    long = "wörter über " * 40_000
    texts = [None, "", "über maß", "über maß", long, long, "a <S> b", "𝔘nicode ❤ x", "x"]
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", 3, 4, "z") for i, t in zip([1, 2, 3, 3, None, 5, 6, 7, None], texts)], ODD).withColumnRenamed("ab", "a.b")


def by_hand(i, text, plain=90, spm=20):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plain:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 511, 512, 513, 5000])
def test_rank_and_select(size):
    rng = np.random.default_rng(size)
    for share in (0.02, 0.5, 1):
        bits = rng.random(size) < share
        v = fim.BitVector(bits)
        ones = np.flatnonzero(bits)
        assert v.total == len(ones)
        assert (v.rank(np.arange(size + 1)) == np.concatenate([[0], np.cumsum(bits)])).all()
        assert (v.select(np.arange(len(ones))) == ones).all()


def test_fill_in_middle_of_odd_rows(odd):
    out = fim.fill_in_middle(odd).withColumn("back", fim.restored()).collect()
    assert len(out) == 9
    for r in out:
        assert tuple(r[c] for c in ("n", "form", "prefix_chars", "middle_chars", "fim_text")) == by_hand(r.doc_id, r.text)
        assert r.back == (r.text or "") and r["a.b"] == 3 and r.fim_id == 4 and r.word == 2
    assert any(r.form != "plain" for r in out)
    # marks that could arise over a border
    rows = odd.sparkSession.createDataFrame([(i, t) for i in range(300) for t in ("<<S", "S><P", ">M><", "<")], "doc_id long, text string")
    out = fim.fill_in_middle(rows, plain=100, spm=50).withColumn("back", fim.restored())
    assert out.where("back <> text").isEmpty() and {r.form for r in out.select("form").distinct().collect()} == {"psm", "spm"}


def test_fill_in_middle_of_no_rows(odd):
    assert fim.fill_in_middle(odd.limit(0)).count() == 0


def test_fill_in_middle_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = queries.op11_fim(spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        *head, made = by_hand(r.doc_id, texts[r.doc_id])
        assert tuple(r) == (r.doc_id, *head, sha(made), sha(texts[r.doc_id] or ""))


def words_by_hand(rows, every=31):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % every == 0 else w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups_by_hand(counts, least=2):
    counts = {w: n for w, n in counts.items() if n >= least}
    by_piece = {}
    for w in counts:
        for i in range(len(w)):
            by_piece.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    out, forms = {}, {}
    for w, n in counts.items():
        met = set()
        for i in range(len(w)):
            met |= by_piece[w[:i] + w[i + 1 :]]
            met |= {w[:i] + w[i + 1 :]} & counts.keys()
        met |= by_piece.get(w, set())
        met = [x for x in met if near(w, x)]
        best = min(met, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 10 * n else None
        out[w] = (n, len(met))
    for w in out:
        root = w
        while forms.get(root):
            root = forms[root]
        out[w] = (w, forms[w], root, *out[w], counts.get(forms[w]))
    return out


def random_words(seed, letters, size, top):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(7, 10))): rng.choice([2, 2, 3, 5, 40, 600, top]) for _ in range(size)}


@pytest.mark.parametrize("letters, crowd, chunk", [("ab", 10**6, 10**6), ("ab", 5, 3), ("abcö", 10**6, 50), ("abcö", 20, 50), ("aÿ", 3, 1)])
def test_spelling_groups_against_brute_force(spark, letters, crowd, chunk):
    counts = random_words(3, letters, 400, 9000) | {"aaaaaaa": 5, "aaaaaaaa": 50, "baaaaaaa": 700, "once" * 2: 1}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    out = spellings.spelling_groups(df, crowd=crowd, chunk=chunk).collect()
    assert {r.word: tuple(r) for r in out} == groups_by_hand(counts) and len(out) == len(counts) - 1


def test_automaton_numbers_and_size():
    words = sorted({"".join(p).encode() for p in (("walk" + s, "talk" + s) for s in ("", "s", "ed", "ing")) for p in p})
    a = spellings.Automaton(words)
    assert [a.number(w) for w in words] == list(range(len(words))) and a.number(b"wal") == a.number(b"walks ") == -1
    assert len(a.arcs) == 9  # shared beginnings and ends once: start, a, l, k, end, e, i, n and what k leads to
    assert spellings.Automaton([]).number(b"") == -1


def test_count_words_of_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for every in (31, 2):
        got = {r.word: r.n for r in spellings.count_words(odd, every).collect()}
        assert got == words_by_hand(rows, every)
    names = spark.createDataFrame([(i, f"Ångström{i} naïveté ŁÓDŹlongword Überraschung×÷xxxx {'Wort' * i}") for i in range(40)], "doc_id long, text string")
    assert {r.word: r.n for r in spellings.count_words(names, 3).collect()} == words_by_hand([tuple(r) for r in names.collect()], 3)
    assert spellings.spelling_groups(spellings.count_words(odd.limit(0))).count() == 0


def test_spelling_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = queries.op12_spellings(spark, sf).collect()
    assert {r.word: tuple(r) for r in out} == groups_by_hand(words_by_hand(rows))
    assert any(r.form for r in out) and any(r.n_near for r in out)
