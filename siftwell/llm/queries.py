"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fim, flatgraph, langid, packing, pii, sadedup, simhash, spellings, spotsigs, topk, toxicity, urlfilter
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade_toxicity(docs, model)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"), with_text=False)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"), k=10)


def op5_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urlfilter.train_url_weights(urlfilter.labelled_urls(spark))
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), weights).select("page_id", "host", "path", "rule", "verdict")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = langid.default_path()
    model = langid.train_language_id(docs.where(~held_out() & F.col("doc_id").isNotNull()), path)
    found = langid.identify_language(docs, model, path)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), bpe.default_path())


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing_path(), with_ids=False)


def packing_path() -> str:
    return bpe.default_path()


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < 4)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS[:4])]
    more = [count(4).alias("n_term"), F.size("spans").cast("long").alias("n_spans")]
    return found.select("doc_id", *counts, F.sha2(pii.span_list(base), 256).alias("base_sha256"), pii.span_list(F.col("spans")).alias("spans"), *more)


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sadedup.repeated_bytes(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    digests = [F.sha2("fim_text", 256).alias("output_sha256"), F.sha2(fim.restored(), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.spelling_groups(spellings.count_words(table(spark, sf_dir, "documents")))


def op13_flatgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_spotsigs, op4_topk, op5_urlfilter, op6_langid, op7_bpe, op8_packing, op9_pii, op10_suffix, op11_fim, op12_spellings, op13_flatgraph)}

_OP4 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024::DOUBLE * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_OP10 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, (length(hex(encode(coalesce(text, '')))) // 2)::BIGINT AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, (2 * p + 1)::BIGINT, 200)) AS m FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d WHERE n >= 100)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY m ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS island
      FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM r)),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, island),
g AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM s),
t AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS z, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS head
      FROM g JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(t.head || substr(h, 2 * t.z + 1), h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""

_OP11 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (SELECT doc_id, t, n, ('0x' || s[1:8])::BIGINT % (n + 1) AS x, ('0x' || s[9:16])::BIGINT % (n + 1) AS y,
             ('0x' || s[17:24])::BIGINT % 100 AS f, ('0x' || s[25:32])::BIGINT % 100 AS g FROM d),
c AS (SELECT doc_id, t, n, least(x, y) AS a, greatest(x, y) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR f >= 90 THEN 'plain' WHEN g < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

ORACLE: dict[str, str] = {"op4_topk": _OP4, "op10_suffix": _OP10, "op11_fim": _OP11}
