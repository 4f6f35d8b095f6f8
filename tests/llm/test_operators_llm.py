"""The training-data operators against brute force, and their edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from siftwell.llm import bpe, langid, packing, pii, queries, sadedup, simhash, spotsigs, topk, toxicity, urlfilter

ODD = "doc_id long, text string, spans int, d string, fp string, id int, ids string, word int, __row string"


def odd_rows(texts, ids=None):
    return [(i, t, 1, "x", "y", 2, "z", 3, "w") for i, t in zip(ids or range(len(texts)), texts)]


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, null, empty, repeated and long texts, columns of clashing names."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    rows = odd_rows([None, "", "a b c", "a b c", long, long, "über x@y.org", "x"], [1, 2, 3, 3, None, 5, 6, None])
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


# --- 1 toxicity --------------------------------------------------------------------------------------------

def test_ordinal_gradient_finds_order():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (600, 5)).astype(np.float32)
    score = x @ np.array([3, 1, 0, 0, -2.0])
    grade = (score > 0.5).astype(int) + (score > 2.5)
    w, t = toxicity.fit_ordinal(toxicity.SparseRows.of([dict(enumerate(r)) for r in x.tolist()], 5), grade)
    below = toxicity.sigmoid(t[None] - (x @ w)[:, None])
    assert (np.diff(t) > 0).all() and ((below < 0.5).sum(axis=1) == grade).mean() > 0.95


def test_toxicity_on_held_out_labels(spark, sf):
    docs, known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train_toxicity(docs, known.where("doc_id % 3 <> 0"))
    out = toxicity.grade_toxicity(docs, model).join(known.where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("y")), "doc_id").toPandas()
    assert ((out.toxic == (out.y == 1)).mean() > 0.95) and out.severity.between(0, 2).all()
    assert out[out.y == 1].severity.mean() > 5 * out[out.y == 0].severity.mean()


def test_severity_follows_insults(spark):
    """Labels only say toxic or not; on other texts, severity rises with the number of insults, and without any it is low."""
    rng = random.Random(16)
    name = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    plain, insults = [name() for _ in range(300)], [name() for _ in range(6)]
    text = lambda n: " ".join(rng.sample([*(rng.choice(plain) for _ in range(60)), *(rng.choice(insults) for _ in range(n))], 60 + n))
    known = [(i, text(n), int(n > 0)) for i, n in enumerate([0] * 600 + [rng.choice([1, 2, 3, 6, 9]) for _ in range(200)])]
    docs = spark.createDataFrame(known, "doc_id long, text string, toxic int")
    model = toxicity.train_toxicity(docs.drop("toxic"), docs.drop("text"))
    new = [(i, text(n), n) for i, n in enumerate([0, 1, 3, 9] * 50)]
    out = toxicity.grade_toxicity(spark.createDataFrame(new, "doc_id long, text string, n int"), model).toPandas().sort_values("doc_id")
    mean = [out.severity[i::4].mean() for i in range(4)]
    assert mean == sorted(mean) and out.severity[0::4].max() < 0.3 and mean[3] > 1.5 and mean[1] > 3 * mean[0]


def test_toxicity_query_against_brute_force(spark, texts, sf):
    """Scores of whole texts, word by word, from the same model; all words count."""
    docs, known = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train_toxicity(docs, known)
    got = queries.op1_toxicity(spark, sf).toPandas().set_index("doc_id")
    assert len(got) == len(texts) and (model.weights != 0).sum() > 3
    for i, text in texts.items():
        counts = {}
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            for feature in [word, "^" + word[:4]][: 1 + (len(word) > 4)]:
                b = xxhash.xxh64_intdigest(feature, 7) % toxicity.DIMS
                counts[b] = counts.get(b, 0) + 1
        score = sum(float(model.weights[b]) * np.log1p(n) for b, n in counts.items())
        above = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        assert got.loc[i].severity == pytest.approx(sum(above)) and got.loc[i].p_toxic == pytest.approx(above[0])


def test_toxicity_edges(spark, odd, none):
    empty = toxicity.train_toxicity(none, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.grade_toxicity(odd, empty).toPandas()
    assert len(got) == 8 and (got.grade == 0).all() and not got.toxic.any()
    assert toxicity.grade_toxicity(none, empty).count() == 0
    nulls = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    assert (toxicity.grade_toxicity(odd, toxicity.train_toxicity(odd, nulls)).toPandas().grade == 0).all()


# --- 2 SimHash ---------------------------------------------------------------------------------------------

def slow_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(codes, bits):
    label = {c: c for c in codes}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(codes, 2):
        if (a ^ b).bit_count() <= bits:
            x, y = root(a), root(b)
            label[max(x, y)] = min(x, y)
    return {c: root(c) for c in codes}


def test_simhash_against_brute_force(spark, texts, sf):
    got = queries.op2_simhash(spark, sf).toPandas()
    codes = {i: slow_fingerprint(t) for i, t in texts.items()}
    assert dict(zip(got.doc_id, got.fingerprint)) == {i: f"{c:016x}" for i, c in codes.items()}
    part, least = slow_components(sorted(set(codes.values())), 2), {}
    for i, c in codes.items():
        least[part[c]] = min(i, least.get(part[c], i))
    assert dict(zip(got.doc_id, got.component_id)) == {i: least[part[c]] for i, c in codes.items()}


def test_spark_and_xxhash_agree(spark):
    row = spark.createDataFrame([("a é b",)], "s string").select(F.xxhash64("s")).first()[0]
    assert row & (1 << 64) - 1 == xxhash.xxh64_intdigest("a é b".encode(), 42)


@pytest.mark.parametrize("run,top", [(512, 512), (16, 4), (3, 1)])
def test_gray_index_finds_every_link(spark, run, top):
    from siftwell.llm.common import connected

    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    codes = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(4))) for b in base for _ in range(8)} | {0, 1, (1 << 64) - 1}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    edges = simhash.fingerprint_edges(spark.createDataFrame([(c,) for c in signed], "fp long"), 2, run, top)
    got = {r.node & (1 << 64) - 1: r.component for r in connected(edges).collect()}
    want = slow_components(sorted(codes), 2)
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    assert groups(got) == [g for g in groups(want) if len(g) > 1]
    s = np.array(sorted(codes, key=lambda c: int(simhash.gray_rank(np.array([c], np.uint64))[0])), np.uint64)
    i, j = simhash.links_between(s[:101], s[101:], 2)
    left, right = s[:101].tolist(), s[101:].tolist()
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(101) for b in range(len(right)) if (left[a] ^ right[b]).bit_count() <= 2]


def test_gray_index_prunes_groups(spark):
    """Most pairs of runs go unseen at the upper levels, whichever levels there are; the same pairs are left."""
    fps = simhash.simhash(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).select("fp").distinct()
    runs = simhash.gray_runs(fps, 32)
    n = runs.count()
    one = simhash.near_runs(simhash.node_levels(runs, n), 2)
    levels = simhash.node_levels(runs, 3)
    assert len(levels) > 2 and [x.count() for x in levels] == sorted((x.count() for x in levels), reverse=True)
    left = simhash.near_runs(levels, 2)
    assert left.count() == left.distinct().count() and left.exceptAll(one).count() == 0 and one.exceptAll(left).count() == 0
    assert left.count() < 0.35 * n * (n + 1) / 2


def test_simhash_edges(odd, none):
    got = simhash.near_duplicates(odd).toPandas()
    assert len(got) == 8 and simhash.near_duplicates(none).count() == 0
    by = got.groupby("fp").component_id.nunique(dropna=False)
    assert (by == 1).all() and set(got[got.fp == 0].component_id) == {1}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.text or "" for r in kept.collect())[:2] == ["", "a b c"]
    assert kept.count() == got.component_id.fillna(-1).nunique()


def slow_copies(texts, least=0.8):
    """Component of each id by the likeness of five-word shingles."""
    sets = {}
    for i, t in texts.items():
        w = re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (t or "").encode()).split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    label = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
            x, y = sorted((label[a], label[b]))
            label = {i: x if c == y else c for i, c in label.items()} if x != y else label
    return label


def test_near_copies_against_brute_force(spark, texts):
    import corpus_pipeline as cp

    rng = random.Random(6)
    noise = lambda n: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(n))
    cases, base = dict(texts), noise(120).split()
    for i in range(10_000, 10_060):  # copies of 0 to 7 changed words, and texts that share a passage
        own = list(base)
        for k in rng.sample(range(120), rng.randrange(8)):
            own[k] = f"w{i}x{k}"
        cases[i] = " ".join(own) if i % 2 else " ".join(base[:60]) + " " + noise(rng.choice([5, 15, 60]))
    df = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    want = slow_copies(cases)
    assert {r.doc_id for r in cp.near_dedup(spark, df, "").collect()} == set(want.values())
    from siftwell.llm import nearcopies

    assert {r.doc_id: r.component_id for r in nearcopies.near_copies(df).collect()} == want


def test_no_near_copy_of_short_texts_is_lost(spark):
    """Pairs of few shingles, whose fingerprints say little: every link at a likeness of 0.8 or more."""
    rng = random.Random(8)
    cases = {}
    for i in range(300):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(8, 30))]
        cases[3 * i] = " ".join(own)
        cases[3 * i + 1] = " ".join(own[rng.randrange(2) :] + [f"x{k}" for k in range(rng.randint(0, 3))])
        cases[3 * i + 2] = " ".join(own[: len(own) - rng.randrange(4)])
    from siftwell.llm import nearcopies

    df = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in nearcopies.near_copies(df).collect()} == slow_copies(cases)


def test_one_of_each_group_with_odd_ids(spark):
    """Null and repeated ids, columns of clashing names: one row of each group stays."""
    a, b, c = "one two three four five six seven", "eight nine ten eleven twelve thirteen", "x y z"
    rows = [(1, a), (1, a), (2, a), (3, b), (3, c), (None, c), (None, "alone"), (None, "alone"), (4, "alone too"), (None, "p q"), (5, b)]
    df = spark.createDataFrame([(i, t, n, "r") for n, (i, t) in enumerate(rows)], "doc_id long, text string, id int, row string")
    from siftwell.llm import nearcopies

    for keep in (simhash.keep_one, nearcopies.keep_one):
        got = keep(df)
        assert got.columns == df.columns
        assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(1, a), (3, b), (3, c), (0, "alone"), (4, "alone too"), (0, "p q")])


def test_near_copies_edges(odd, none):
    from siftwell.llm import nearcopies

    got, kept = nearcopies.near_copies(odd).toPandas(), nearcopies.keep_one(odd)
    assert len(got) == 8 and nearcopies.near_copies(none).count() == 0 and set(got[got.fp == 0].component_id) == {1}
    assert kept.columns == odd.columns and kept.count() == got.component_id.fillna(-1).nunique()


# --- 3 SpotSigs --------------------------------------------------------------------------------------------

def test_spotsigs_against_plain_sets(spark, texts, sf):
    got = queries.op3_spotsigs(spark, sf).toPandas().set_index("doc_id")
    order = sorted(texts, reverse=True)

    def spots(text):
        words = [w for w in re.split(r"[^\w]|_", text.lower()) if w]
        content, out = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS], set()
        for i, w in enumerate(words):
            if w in spotsigs.ANCHORS:
                chain = [words[k] for k in content if k > i][:2]
                if len(chain) == 2:
                    out.add((w, *chain))
        return out or {text}

    sets = {i: spots(t) for i, t in texts.items()}
    like = lambda a, b: len(a & b) / len(a | b)
    assert max(map(len, texts.values())) > 10_000
    for k, i in enumerate(order):
        nxt, row = order[(k + 1) % len(order)], got.loc[i]
        n = len(texts[i]) // 3
        new = texts[i][: len(texts[i]) - n] + texts[nxt][:n]
        assert row.n_chars == len(texts[i]) and row.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert row.near_next == pytest.approx(like(sets[i], sets[nxt])) and row.near_edited == pytest.approx(like(sets[i], spots(new)))
        # the likenesses follow from the fingerprints, which list the sets
        own, other, after = (spotsigs.members(f) for f in (row.fingerprint, row.edited_fingerprint, got.loc[nxt].fingerprint))
        assert len(own) == len(sets[i]) and row.near_edited == spotsigs.jaccard(own, other) and row.near_next == spotsigs.jaccard(own, after)


def test_pruned_jaccard():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (np.array(sorted(rng.sample(range(60), rng.randrange(1, 50))), np.uint32) for _ in range(2))
        if rng.random() < 0.3:
            b = np.array(sorted({*a.tolist()} | {rng.randrange(60)}), np.uint32)
        want = len({*a.tolist()} & {*b.tolist()}) / len({*a.tolist()} | {*b.tolist()})
        assert spotsigs.jaccard(a, b) == want
        for least in (0.3, 0.8):
            assert spotsigs.jaccard(a, b, least, 4) == (want if want >= least else 0.0)


def test_order_of_repeated_and_missing_ids(spark):
    """Rows of one id, or of none, are spread over the buckets, and every row but the last is followed by the next one."""
    rows = [(rng_id, f"the house of number {i} is on a street") for i, rng_id in enumerate([5] * 40 + [None] * 40 + list(range(10, 30)))]
    out = spotsigs.in_order(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("ghost = 0").count() == 100 and out.select("bucket").distinct().count() > 2
    got = spotsigs.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    h = {r.text: r.h for r in spark.createDataFrame(rows, "doc_id long, text string").select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), h[r[1]]))
    want = sorted((spotsigs.edited(a[1], b[1])) for a, b in zip(order, [*order[1:], order[0]]))
    assert sorted(got.edited) == want


def test_spotsigs_edges(spark, odd, none):
    got = spotsigs.edited_fingerprints(odd).toPandas()
    assert len(got) == 8 and got.fingerprint.notna().all() and spotsigs.edited_fingerprints(none).count() == 0
    one = spotsigs.edited_fingerprints(spark.createDataFrame([(7, "the cat sat on the mat in a house")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited.endswith("the cat sat"[: 33 // 3])


def test_similar_fingerprints(spark):
    rng = random.Random(2)
    sets = {}
    for g in range(12):
        base = sorted(rng.sample(range(10_000), 40))
        for k in range(4):
            s = set(base) - set(rng.sample(base, k * 3)) | set(rng.sample(range(10_000), k * 2))
            sets[f"{g}-{k}"] = sorted(s)
    df = spark.createDataFrame(list(sets.items()), "fingerprint string, sigs array<long>")
    got = {frozenset((r.a, r.b)) for r in spotsigs.similar_fingerprints(df, 0.8).collect()}
    want = {frozenset((a, b)) for a, b in itertools.combinations(sets, 2) if len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) >= 0.8}
    assert got == want and want


# --- 4 top-k -----------------------------------------------------------------------------------------------

def test_topk_ties_junk_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(300)]
    rows += [(100, rows[100][1]), (400, None), (401, [1.0, None, 1.0, 1.0]), (402, [float("nan")] * 4), (500, [float("inf")] * 4), (None, [1.0] * 4), (600, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 100 = 0"), 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and len(v) == 4 and None not in v and np.isfinite(v).all()]
    for q in (0, 100, 200):
        query = next(v for i, v in good if i == q)
        best = sorted(((-int(query @ v), i) for i, v in good if i != q))[:10]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert set(got) == {0, 100, 200}
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_topk_over_many_cells(spark, monkeypatch):
    """Small cells, blocks and batches; clusters, so that cells are pruned; a vector that a third of the rows share."""
    for name, value in (("CELL", 16), ("BLOCK", 4), ("BATCH", 3), ("SLOT", 2), ("CHUNK", 5)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 4
    rows = [(i, [float(x) for x in np.round(centres[i % 12] + rng.normal(size=8) * 0.05, 3)]) for i in range(400)]
    rows += [(i, [1.0] * 8) for i in range(400, 600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clean = df.select(F.col("vec_id").alias("id"), topk.quantised(F.col("embedding")).alias("v"))
    cells = topk.block_cells(clean, 16)
    assert cells.count() >= 38
    codes = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in rows}
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 20 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert len(got) == 30
    for q, found in got.items():
        best = sorted((-int(codes[q] @ v), i) for i, v in codes.items() if i != q)[:5]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    # what the second step sends: fewer than half of all pairs of query and cell
    least = F.lit(float(min(s for _, _, s in got[0])))
    asked = clean.where("id = 0").withColumns({"w": F.size("v"), "batch": F.lit(0), "least": least, "own": F.lit(-1).cast("long")})
    assert 0 < topk.near_cells(asked, cells, every=True).count() < 0.5 * cells.count()


def test_topk_large_components():
    ids, v = np.arange(3), np.array([[2**40, 1], [2**40, 0], [-(2**40), 5]])
    assert topk.search_cell(ids, v, np.array([0]), v[:1] // 2**20, 1) == [(0, 1, 2**60)]


# --- 5 URLs ------------------------------------------------------------------------------------------------

def test_url_rules_and_parts(spark):
    w = urlfilter.train_url_weights(urlfilter.labelled_urls(spark))
    rows = [None, "no url", "http://A.Example.COM/en/x?y", "http://www.example.com/en/1", "http://x.www.example.com/en/", "https://m.b.net/es/#t", "http://net/fr/", "http://notexample.com/en/", "http://a.com", "x://h?p#/f", "ftp://u\n.com/a\nb"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id int, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge_urls(df, w).collect()}
    assert got[0][:3] == got[1][:3] == ("", "", None)
    assert got[2] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[3][2:] == got[4][2:] == ("www.example.com/en/", "allow")
    assert got[5][1:] == ("/es/", "net/es/", "block") and got[6][2] == "net/fr/" and got[7][2:] == ("com/", "allow")
    assert got[8][2] is None and got[9][:2] == ("h", "") and got[10][:2] == ("u\n.com", "/a\nb")
    assert urlfilter.judge_urls(df.limit(0), w).count() == 0


def test_url_model_learns(spark):
    w = urlfilter.train_url_weights(urlfilter.labelled_urls(spark).where("url not like '%video%'"))
    out = urlfilter.judge_urls(urlfilter.labelled_urls(spark).withColumn("page_id", F.lit(1)), w, rules=[])
    right = out.join(urlfilter.labelled_urls(spark), "url").select(F.avg(((F.col("verdict") == "block") == (F.col("label") == 1)).cast("int"))).first()[0]
    assert right > 0.9
    assert urlfilter.train_url_weights(urlfilter.labelled_urls(spark).limit(0), dims=8) == [0.0] * 9
    with pytest.raises(Exception):
        urlfilter.train_url_weights(urlfilter.labelled_urls(spark), max_rows=5)


def test_url_table_is_apart_from_the_judged_one(spark):
    site = lambda h: F.regexp_replace(h, r"^(www|blog|m)\\.", "")
    judged = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select(site(urlfilter.url_host(F.col("url"))).alias("h"))
    learned = urlfilter.labelled_urls(spark).select(site(urlfilter.url_host(F.col("url"))).alias("h"))
    assert learned.join(judged, "h", "left_semi").isEmpty()


def test_url_model_on_held_out_hosts(spark):
    """Four folds by host: each is judged by a model that has not seen its hosts."""
    rows = urlfilter.labelled_urls(spark).withColumn("fold", F.pmod(F.xxhash64(urlfilter.url_host(F.col("url"))), F.lit(4)))
    right = []
    for fold in range(4):
        w = urlfilter.train_url_weights(rows.where(F.col("fold") != fold).drop("fold"))
        test = rows.where(F.col("fold") == fold).withColumn("page_id", F.monotonically_increasing_id())
        out = urlfilter.judge_urls(test, w, rules=[]).join(test.select("page_id", "label"), "page_id")
        right += [(r.verdict == "block") == (r.label == 1) for r in out.collect()]
    assert len(right) == 155 and np.mean(right) > 0.85


def test_url_query_against_plain_rules(spark, sf):
    """op5 on every page: parts and rules in plain Python, and the model's share where no rule fits."""
    w = urlfilter.train_url_weights(urlfilter.labelled_urls(spark))
    got = {r.page_id: r for r in queries.op5_urlfilter(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    hashes = {}
    for url in {r.url for r in pages}:
        head, sep, rest = (url or "").partition("://")
        host = re.split(r"[/?#]", rest)[0].lower() if sep else ""
        path = re.split(r"[?#]", rest[len(host) :])[0] if sep else ""
        fits = [(len(r), r, k) for k, r in urlfilter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        grams = lambda kind, s: {f"{kind}^{s}$"[i : i + 4] for i in range(max(1, len(f"{kind}^{s}$") - 3))}
        hashes[url] = (host, path, max(fits)[1:] if fits else None, grams("h", host) | grams("p", re.sub("[0-9]+", "0", path)))
    signed = lambda g: (x := xxhash.xxh64_intdigest(g.encode(), 42)) - (1 << 64 if x >> 63 else 0)
    for r in pages:
        host, path, rule, grams = hashes[r.url]
        own = got[r.page_id]
        score = w[-1] + sum(w[b] for b in {signed(g) % (len(w) - 1) for g in grams})
        assert (own.host, own.path, own.rule) == (host, path, rule and rule[0])
        assert own.verdict == (rule[1] if rule else "block" if score >= 0 else "allow")


# --- 6 language --------------------------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    index = langid.PieceIndex({"a": 0, "b": 1, "ab": 2, "▁": 3, "▁a": 4})
    prob = np.array([[0.1, 0.2], [0.2, 0.1], [0.3, 0.3], [0.1, 0.1], [0.05, 0.2], [0, 0], [1e-8, 1e-8]])

    def total(word, k):
        return 1.0 if not word else sum(prob[index[word[:n]], k] * total(word[n:], k) for n in range(1, len(word) + 1) if word[:n] in index)

    for word in ("▁ab", "▁aab", "▁abab"):
        got = langid.forward(langid.lattice([word], index), prob)[0, -1]
        assert got == pytest.approx([total(word, 0), total(word, 1)])


def test_held_out_accuracy(spark, sf):
    got = queries.op6_langid(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert (held.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in held.doc_id]).all()
    assert (held.lang_pred == held.lang).mean() > 0.97 and got.score.between(0, 1).all()


def test_long_words_and_training_by_all_segmentations():
    index = langid.PieceIndex({"a": 0, "b": 1, "ab": 2, "▁": 3, "▁a": 4, "bab": 5})
    rng = np.random.default_rng(3)
    prob = np.vstack([rng.random((6, 2)) * 1e-6, [[0, 0], [1e-8, 1e-8]]])
    word = "▁" + "".join(rng.choice(list("abx"), 400))
    total = [[0.0, 0.0]]  # logs, end by end
    for end in range(1, len(word) + 1):
        ways = [(np.log(prob[index.get(word[end - n : end], 7 if n == 1 else 6)]), total[end - n]) for n in range(1, min(end, 3) + 1) if n == 1 or word[end - n : end] in index]
        total.append([np.logaddexp.reduce([p[k] + t[k] for p, t in ways]) for k in range(2)])
    got = langid.log_forward(langid.lattice([word], index), prob)[0]
    assert np.allclose(got, total) and got[-1, 0] < -1500
    # expected counts: every way to cut the words, weighed by its probability
    one = np.full((8, 1), 1 / 6)
    one[6:] = [[0.0], [1e-8]]
    counts, expected = {"▁ab": 3, "▁abab": 2}, np.zeros(6)

    def ways(w):
        return [[]] if not w else [[w[:n], *rest] for n in range(1, min(3, len(w)) + 1) if w[:n] in index for rest in ways(w[n:])]

    for w, n in counts.items():
        p = [np.prod([one[index[x], 0] for x in way]) for way in ways(w)]
        for way, q in zip(ways(w), p):
            for x in way:
                expected[index[x]] += n * q / sum(p)
    assert np.allclose(langid.fit_pieces(counts, index, rounds=1, smooth=0.02), (expected + 0.02) / (expected + 0.02).sum())


def test_language_query_against_brute_force(spark, texts, sf):
    """op6 on whole texts, word by word and without arrays over words, from the same model."""
    import regex

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.train_language_id(docs.where(~queries.held_out()), langid.default_path())
    index = langid.pieces(langid.default_path())
    longest, memo = max(map(len, index)), {}

    def likelihood(word):
        if word not in memo:
            a = [np.zeros(len(model.langs))]
            for end in range(1, len(word) + 1):
                at = [(n, index.get(word[end - n : end])) for n in range(1, min(end, longest) + 1)]
                logs = [np.log(model.prob[i]) + a[end - n] if i is not None else np.log(langid.UNKNOWN) + a[end - 1] for n, i in at if i is not None or n == 1]
                a.append(np.logaddexp.reduce(logs, axis=0))
            memo[word] = a[-1]
        return memo[word]

    got = queries.op6_langid(spark, sf).toPandas().set_index("doc_id")
    assert len(got) == len(texts)
    for i, text in sorted(texts.items())[:60]:
        words = ["▁" + (w.lower() if len(w) > 1 and w.isupper() else w) for w in regex.findall(r"\p{L}+", text)]
        if not words:
            assert got.loc[i].lang_pred == "und" and got.loc[i].score == 0
            continue
        total = sum(likelihood(w) for w in words)
        mean = np.exp(sum(likelihood(w) / len(w) for w in words) / len(words))
        assert got.loc[i].lang_pred == model.langs[int(total.argmax())] and got.loc[i].score == pytest.approx(mean[int(total.argmax())] / mean.sum())
    assert got.score[got.lang_pred != "und"].std() > 0.005


def test_language_edges(spark, odd, none, texts, sf):
    path = langid.default_path()
    model = langid.train_language_id(odd.withColumn("lang", F.lit("en")), path)
    got = langid.identify_language(odd, model, path).toPandas()
    assert (got.lang_pred == ["und", "und"] + ["en"] * 6).all()
    kept = langid.keep_language(odd, model, path)
    assert kept.columns == odd.columns and kept.count() == 6
    model = langid.train_language_id(none.withColumn("lang", F.lit("en")), path)
    assert model.langs == [] and (langid.identify_language(odd, model, path).toPandas().lang_pred == "und").all()
    assert langid.keep_language(odd, model, path).count() == 6 and langid.keep_language(none, model, path).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.train_language_id(docs, path)
    rng = random.Random(15)
    junk = [(-i, "".join(rng.choice("qxzjvkwQXZJVKW") for _ in range(9)) + " " + "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(400))) for i in range(1, 9)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(junk, "doc_id long, text string"))
    kept = {r.doc_id for r in langid.keep_language(both, model, path).collect()}
    assert kept == {i for i, t in texts.items() if any(c.isalpha() for c in t)}


# --- 7 BPE, 8 packing --------------------------------------------------------------------------------------

TRICKY = ["", " ", "Hello  World's ÀÉ #1<|endoftext|> ok \x1c a\u0000b ΣΑΣ 日本 é", "İ ǅ ß ſ K <|startoftext|>a<|b", "x" * 3000, "a\u0301 é 👩‍👩‍👧 don't I'LL ½²!!!", "\u0085q\u00a0z\u2003"]


def test_bpe_matches_the_library(texts):
    from tokenizers import Tokenizer

    path = bpe.default_path()
    t, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    rng = random.Random(4)
    cases = TRICKY + [x for _, x in sorted(texts.items())[:80]] + ["".join(rng.choice("aAbéÉ' \n1½Σσ.,!<|>\x1c日́") for _ in range(50)) for _ in range(200)]
    for arrays in (False, True):
        own.known, own.before = {}, {}
        ids, counts = own.encode_column(cases, arrays)
        for case, n, end in zip(cases, counts, np.cumsum(counts)):
            want = t.encode(case, add_special_tokens=False).ids
            assert ids[end - n : end].tolist() == want
            assert own.decode(want) == t.decode(want, skip_special_tokens=False)


def test_bpe_query_against_the_library(spark, texts, sf):
    from tokenizers import Tokenizer

    t, got = Tokenizer.from_file(bpe.default_path()), queries.op7_bpe(spark, sf).toPandas().set_index("doc_id")
    assert len(got) == len(texts)
    for i, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert tuple(got.loc[i]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), digest)


def test_bpe_edges(odd, none):
    got = bpe.bpe_round_trip(odd, bpe.default_path()).toPandas()
    assert len(got) == 8 and list(map(len, got.ids))[:4] == [0, 0, 3, 3] and got.decoded[2] == "a</w> b</w> c</w>"
    assert bpe.bpe_round_trip(none, bpe.default_path()).count() == 0
    assert bpe.bpe_digests(odd, bpe.default_path()).first().ids_sha256 == hashlib.sha256(b"").hexdigest()


def slow_cost(places, penalty, size):
    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= size:
                pad = 0 if n & (n - 1) == 0 and n >= 256 else size - n
                best[j] = min(best[j], best[i] + pad + penalty[j])
    return best[-1]


def test_best_cuts_are_best():
    rng = random.Random(6)
    for _ in range(40):
        places = [0, *itertools.accumulate(rng.choice([1, 40, 64, 128, 200, 300]) for _ in range(rng.randrange(1, 60)))]
        penalty = [float(rng.choice([0, 16, 256])) for _ in places]
        cuts = [0] + packing.best_cuts(places, penalty, 512)
        got = sum((0 if (n := places[b] - places[a]) & (n - 1) == 0 and n >= 256 else 512 - n) + penalty[b] for a, b in itertools.pairwise(cuts))
        assert cuts[-1] == len(places) - 1 and got == slow_cost(places, penalty, 512)


def test_packing_covers_every_id_once(spark, sf, texts):
    got = packing.pack_documents(spark.read.parquet(f"{sf}/documents.parquet"), bpe.default_path()).toPandas()
    own = bpe.WordBpe(bpe.default_path())
    for doc, rows in got.sort_values("start").groupby("doc_id"):
        ids = [i for r in rows.ids for i in r]
        assert ids == own.encode(texts[doc]) + [2] and (rows.doc_tokens == len(ids)).all()
        assert rows.start.tolist() == np.cumsum([0, *rows.length[:-1]]).tolist()
    assert set(got.doc_id) == set(texts)
    used = []
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == np.cumsum([0, *rows.length[:-1]]).tolist()
        used.append(rows.length.sum())
        assert rows.doc_id.is_monotonic_increasing
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in used)
    assert max(used) <= 4096 and padding < 0.03 * sum(used)
    assert all(zlib.crc32(np.array(i, "<u4").tobytes()) == c for i, c in zip(got.ids, got.ids_crc32))


def test_packing_edges(odd, none):
    got = packing.pack_documents(odd, bpe.default_path()).toPandas()
    assert got.length.sum() == sum(len(i) for i in bpe.bpe_round_trip(odd, bpe.default_path()).toPandas().ids) + 8
    assert packing.pack_documents(none, bpe.default_path()).count() == 0


# --- 9 PII -------------------------------------------------------------------------------------------------

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def slow_spans(text):
    out = []
    for k, p in enumerate(PLAIN):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == 2 and not (14 <= len(d) <= 19 and sum((int(c) * 2 - 9 * (c > "4")) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0):
                continue
            if k == 3 and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_against_plain_patterns(spark, texts):
    rng = random.Random(8)
    cases = list(texts.values()) + [None, "", "é a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.1", "4785380592391139 4785-3805 9239-1139", "+1 (743) 555-3824+44.20.7946.0018", "a" * 50_000 + "@b.co", "1" * 20_000]
    cases += ["".join(rng.choice("a1.2@+- ()%_é05") for _ in range(80)) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.kind, s.stop) for s in r.spans] for r in pii.find_personal_data(df, support=10**6).select("doc_id", "spans").collect()}
    assert got == {i: slow_spans(t) for i, t in enumerate(cases)}


def test_disclosing_terms(spark):
    rng = random.Random(9)
    rows = [(i, f"mail bo.li@x.org from zorblatt desk {' '.join(rng.choice('abcdefgh') * 3 for _ in range(5))} {i}") for i in range(6)]
    rows += [(i, f"the desk of mail from {' '.join(rng.choice('abcdefgh') * 3 for _ in range(5))} {i}") for i in range(6, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = pii.find_personal_data(df, support=5)
    got = out.where("exists(spans, s -> s.kind = 4)").select("doc_id", F.expr("filter(spans, s -> s.kind = 4).word").alias("w")).collect()
    assert {r.doc_id for r in got} == set(range(6)) and all(r.w == ["Zorblatt".lower()] for r in got)
    clean = out.select(pii.sanitised(F.col("text"), F.col("spans"), F.col("weights")).alias("t")).first().t
    assert clean.startswith("mail [EMAIL] from  desk") and "zorblatt" not in clean


def test_parts_of_an_address_outside_it(spark):
    """Names in the prose that are parts of the address, or of a kind's name, disclose it like any other term."""
    rng = random.Random(10)
    noise = lambda: " ".join(rng.choice("abcdefgh") * 3 for _ in range(5))
    rows = [(i, f"write to anna.schmidt@x.org +1 (743) 555-38{i}0 ask for Anna Schmidt by Mail {noise()} {i}") for i in range(6)]
    rows += [(i, f"write to ask for {noise()} {i} by bob{i}@x.org") for i in range(6, 200)]
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), support=5)
    got = {r.doc_id: r.w for r in out.select("doc_id", F.expr("filter(spans, s -> s.kind = 4).word").alias("w")).collect()}
    assert all(got[i] == (["Anna", "Schmidt", "Mail"] if i < 6 else []) for i in got)
    clean = {r.t.lower() for r in out.where("doc_id < 6").select(pii.sanitised(F.col("text"), F.col("spans"), F.col("weights")).alias("t")).collect()}
    assert not any("anna" in t or "schmidt" in t for t in clean)


def slow_terms(texts, share=0.9):
    """For each text the words (lower-cased) that disclose an entity of it, by counts of rows."""
    word, key = re.compile(r"[^\W_]+"), re.compile(r"(?<![^\W_])(?=[^\W\d_]*\d)(?=\d*[^\W\d_])[^\W_]{20,}")
    own, outside = {}, {}
    for i, t in texts.items():
        spans = slow_spans(t)
        own[i] = {(k, t[a:b].lower()) for a, k, b in spans} | {(9, w) for w in key.findall(t.lower())}
        flags = [True] * len(t)
        for a, _, b in spans:
            flags[a:b] = [False] * (b - a)
        outside[i] = {w.lower() for w in word.findall("".join(c if f else " " for c, f in zip(t, flags)))} if own[i] else set()
    rows = {i: set(word.findall(t.lower())) for i, t in texts.items()}
    df, has = {}, {}
    for i, ws in rows.items():
        for w in ws:
            df[w] = df.get(w, 0) + 1
        for c in own[i]:
            has.setdefault(c, []).append(i)
    out = {i: {w for k, w in own[i] if k == 9} for i in texts}
    for c, where in has.items():
        content = -np.log2(len(where) / len(texts))
        for w in set().union(*(outside[i] for i in where)):
            both = [i for i in where if w in outside[i]]
            if content > 0 and (np.log2((len(both) + 0.5) / (max(df.get(w, 0), len(both)) + 1)) + content) / content > share:
                for i in both:
                    out[i].add(w)
    return out


def test_pii_query_against_brute_force(spark, texts, sf):
    got = queries.op9_pii(spark, sf).toPandas().set_index("doc_id")
    kinds, terms = ["email", "ip", "card", "phone", "term"], slow_terms(texts)
    assert len(got) == len(texts) and got.n_term.sum() > 0
    for i, text in texts.items():
        base, row = slow_spans(text), got.loc[i]
        told = lambda spans: ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)
        assert [row[f"n_{k}"] for k in kinds[:4]] == [sum(s[1] == k for s in base) for k in range(4)]
        assert row.base_sha256 == hashlib.sha256(told(base).encode()).hexdigest()
        found = [(m.start(), 4, m.end()) for m in re.finditer(r"[^\W_]+", text) if m[0].lower() in terms[i] and not any(a < m.end() and m.start() < b for a, _, b in base)]
        assert row.spans == told(sorted(base + found)) and (row.n_term, row.n_spans) == (len(found), len(base) + len(found))


def test_credentials_are_protected(spark):
    rows = [(1, 'set token = "9f8e7d6c5b4a39281706f5e4d3c2b1a0" here'), (2, "set the value here"), (3, "abcdefghijklmnopqrstuvwxyz 12345678901234567890")]
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: [s.word for s in r.spans] for r in out.collect()}
    assert got[1][-1] == "9f8e7d6c5b4a39281706f5e4d3c2b1a0" and got[2] == [] and got[3] == []


def test_durable_tables_leave_no_shuffle_behind(spark):
    """What is stored or checkpointed deletes its shuffles; other queries of the session keep theirs."""
    from siftwell.llm import common

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    rows = [(i, f"{' '.join(f'w{(i % 7) * 50 + k}' for k in range(30))} mail{i}@example.com") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")
    for run in (lambda: common.stored(df), lambda: common.durable(df)):
        held = blocks.shuffleStatuses().size()
        run()
        assert blocks.shuffleStatuses().size() <= held
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_pii_edges(odd, none):
    got = pii.find_personal_data(odd.select("doc_id", "text", "spans"))
    assert got.count() == 8 and got.where("size(spans) = 1").count() == 1 and got.where("spans is null").count() == 0
    assert pii.find_personal_data(none).count() == 0


# --- 10 suffix arrays --------------------------------------------------------------------------------------

def slow_removal(docs):
    """docs in order; for each the flags of the bytes to remove."""
    seen, out = set(), []
    for text in docs:
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - 99):
            if (w := text[p : p + 100]) in seen:
                gone[p : p + 100] = True
            seen.add(w)
        out.append(gone)
    return out


def check_removal(spark, docs):
    got = sadedup.repeated_bytes(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).toPandas().set_index("doc_id")
    raw = {i: t.encode() for i, t in docs.items()}
    for (i, text), gone in zip(sorted(raw.items()), slow_removal([raw[i] for i in sorted(raw)])):
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        assert tuple(got.loc[i][["n_bytes", "n_removed", "kept_sha256"]]) == (len(text), gone.sum(), hashlib.sha256(kept).hexdigest())
        assert got.loc[i].n_spans == (np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()


def test_removal_against_brute_force(spark, texts):
    check_removal(spark, texts)


def test_removal_on_repetitive_texts(spark, monkeypatch):
    rng = random.Random(11)
    line = "".join(rng.choice("abcdé ") for _ in range(130))
    docs = {i: "".join(rng.choice([line, line[:90], line[20:], "ab" * 40, "a" * 130, rng.choice("xyz") * 7, "\x00\x01"]) for _ in range(rng.randrange(1, 7))) for i in range(60)}
    check_removal(spark, docs)


def test_crowded_anchors_split_by_window(spark):
    rng = random.Random(12)
    common = "".join(rng.choice("abcdefgh") for _ in range(70))
    noise = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(60))
    texts = [(noise() + common + noise()).encode() for _ in range(30)]
    texts += texts[:3]
    data = pd.DataFrame({"d": range(33), "__id": range(33), "text": [sadedup._zip.compress(t) for t in texts], "rows": [None] * 33})
    import pyarrow as pa

    for i, t in enumerate(texts):
        key, first, count = sadedup.anchors(np.frombuffer(t, np.uint8))
        data.at[i, "rows"] = [{"key": int(k), "packed": int(p) << 8 | int(n), "n": 10**6} for k, p, n in zip(key, first, count)]
    batch = pa.RecordBatch.from_pandas(data, preserve_index=False)
    out = pa.Table.from_batches(list(sadedup._segment_rows(iter([batch])))).sort_by([("key", "ascending"), ("part", "ascending")])
    found = pa.Table.from_batches(list(sadedup._chunk_rows(iter(out.to_batches())))).to_pylist()
    gone = {i: np.zeros(len(t), bool) for i, t in enumerate(texts)}
    for r in found:
        gone[r["d"]][r["start"] : r["stop"]] = True
    for i, flags in enumerate(slow_removal(texts)):
        assert (gone[i] == flags).all()


def test_crowded_windows_are_merged_before_chunks(spark, monkeypatch):
    """A passage between different neighbours in over CROWD texts: its windows are merged by hash, not sent to a chunk."""
    rng = random.Random(14)
    common = "".join(rng.choice("abcdefgh") for _ in range(130))
    noise = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(60))
    docs = {i: noise() + common + noise() for i in range(sadedup.CROWD + 100)}
    merged, seen = sadedup.later_of_crowded, []

    def recorded(windows):
        seen.append(windows)
        return merged(windows)

    monkeypatch.setattr(sadedup, "later_of_crowded", recorded)
    check_removal(spark, docs)
    counts = seen[0].groupBy("key", F.xxhash64("segment")).count()
    assert counts.agg(F.max("count")).first()[0] > sadedup.CROWD


def test_suffix_array_is_sorted():
    rng = random.Random(13)
    for alphabet in (b"a", b"ab", bytes(range(256))):
        text = np.frombuffer(bytes(rng.choice(alphabet) for _ in range(700)), np.uint8)
        order = sadedup.suffix_array(text, sadedup.words_at(text), 100)
        raw = text.tobytes()
        heads = [raw[i : i + 100] for i in order]
        assert sorted(order.tolist()) == list(range(700)) and heads == sorted(heads)


def test_suffix_edges(spark, odd, none):
    got = sadedup.repeated_bytes(odd).toPandas()
    assert len(got) == 8 and got.n_bytes.tolist().count(0) == 2 and sadedup.repeated_bytes(none).count() == 0
    long = got[got.n_bytes > 1000].sort_values("n_removed")
    assert long.n_removed.iloc[1] == long.n_bytes.iloc[1] and long.n_removed.iloc[0] > 0 and long.doc_id.iloc[0] == 5
    kept = sadedup.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == 7


# --- pipeline ----------------------------------------------------------------------------------------------

def test_pipeline_against_brute_force(spark, sf):
    import corpus_pipeline as cp
    from siftwell.llm.common import durable

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs.toPandas()]
    for _, stage in cp.STAGES:
        docs = durable(stage(spark, docs, sf))
        seen.append(docs.toPandas())
    start, lang, one, passages, private, packed = seen
    assert all(list(x.columns) == list(start.columns) for x in (lang, one, passages, private))
    # these texts are of the learned languages, junk among them has letters too
    assert set(lang.doc_id) == set(start[start.text.map(lambda t: any(c.isalpha() for c in t))].doc_id)
    # links at a likeness of 0.8 of five-word shingles
    assert set(one.doc_id) == set(slow_copies(dict(zip(lang.doc_id, lang.text))).values())
    raw = {i: t.encode() for i, t in sorted(zip(one.doc_id, one.text))}
    left = {i: np.frombuffer(t, np.uint8)[~g].tobytes().decode(errors="ignore") for (i, t), g in zip(raw.items(), slow_removal(list(raw.values())))}
    assert dict(zip(passages.doc_id, passages.text)) == {i: t for i, t in left.items() if t}
    assert set(private.doc_id) == set(passages.doc_id) and not private.text.map(slow_spans).map(len).any()
    terms, now, places = slow_terms(dict(zip(passages.doc_id, passages.text))), dict(zip(private.doc_id, private.text)), 0
    for i, text in zip(passages.doc_id, passages.text):
        held = {w.lower() for w in re.findall(r"[^\W_]+", re.sub(r"\[(EMAIL|IP|CARD|PHONE|TERM)\]", " ", now[i]))}
        assert not held & terms[i] and (slow_spans(text) or terms[i] or now[i] == text)
        places += now[i].count("[TERM]")
    assert places or any(terms.values())
    ids = packed.sort_values(["doc_id", "start"]).groupby("doc_id").ids.agg(lambda s: [i for x in s for i in x])
    own = bpe.WordBpe(bpe.default_path())
    assert {i: x for i, x in ids.items()} == {i: own.encode(t) + [2] for i, t in zip(private.doc_id, private.text)}


def test_pipeline_edges(spark, odd, none, tmp_path):
    """Null and repeated ids, null, empty and repeated texts, clashing names, no rows; run() on such tables."""
    import corpus_pipeline as cp

    more = "`__id` int, `__group` int, `__spans` string, `__null` string, `row` string, lang string, n_chars long"
    names = [f.split()[0].strip("`") for f in more.split(", ")]
    wide = odd.withColumns({n: F.lit("1").cast(f.split()[1]) for n, f in zip(names, more.split(", "))})
    for docs in (wide, wide.limit(0), wide.where("text is null")):
        path = str(tmp_path / str(hash(docs)))
        docs.write.parquet(f"{path}/documents.parquet")
        now = spark.read.parquet(f"{path}/documents.parquet")
        for _, stage in cp.STAGES[:-1]:
            now = stage(spark, now, path)
            assert now.columns == docs.columns
        assert cp.run(spark, path).count() >= 0
    assert cp.private_data(spark, wide, "").where("text is null").count() == 1
