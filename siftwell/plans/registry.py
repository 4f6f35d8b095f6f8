"""Every operator on the test tables, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import frames as V
from ..functions import geometry as G
from ..functions import prompts
from ..functions import scales as S
from ..functions import text as X
from ..operators import dedup, fanout, graph, joins, labels, profile, rules, sampling, selection, similarity, tables, timeline
from ..sources import features, metadata, outputs, shards

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- rules and selection -----------------------------------------------------------------------------------

_SELECT = """
WITH o AS (SELECT *, o_orderpriority || ':' || strftime(o_orderdate, '%Y-%m') AS g2,
    concat_ws(';', CASE WHEN o_totalprice IS NULL OR o_totalprice < 50000 THEN 'price_low' WHEN o_totalprice > 400000 THEN 'price_high' END,
      CASE WHEN o_orderstatus IS NULL OR o_orderstatus <> 'F' THEN 'status' END) AS why FROM orders),
a AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) rn, count(*) OVER (PARTITION BY o_custkey) n FROM o WHERE why = ''),
b AS (SELECT *, rn <= least(n, greatest(1, ceil(n * 0.2::DOUBLE)::BIGINT), 3) k1 FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY g2 ORDER BY o_totalprice DESC, o_orderkey) rn2, count(*) OVER (PARTITION BY g2) n2 FROM b WHERE k1),
e AS (SELECT o_orderkey, rn2 <= least(n2, greatest(2, ceil(n2 * 0.5::DOUBLE)::BIGINT)) k2 FROM c)
SELECT o.o_orderkey, o.o_custkey, CASE WHEN e.k2 THEN 1 ELSE 0 END::BIGINT AS select_pass,
  CASE WHEN o.why <> '' THEN o.why WHEN NOT b.k1 THEN 'customer_duplicate' WHEN NOT e.k2 THEN 'month_duplicate' ELSE '' END AS select_reject_reason
FROM o LEFT JOIN b USING (o_orderkey) LEFT JOIN e USING (o_orderkey)
"""


def _selected(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").withColumn("g2", F.concat_ws(":", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM")))
    tests = [
        rules.Rule("price", "o_totalprice", min=50000, max=400000, min_reject_reason="price_low", max_reject_reason="price_high", missing_reject_reason="price_low"),
        rules.Rule("status", "o_orderstatus", equals="F", reject_reason="status"),
    ]
    methods = [selection.GroupKeep("customer", "o_custkey", 0.2, 1, 3, "customer_duplicate"), selection.GroupKeep("month", "g2", 0.5, 2, None, "month_duplicate")]
    return selection.select(o, tests, methods, "o_totalprice", "o_orderkey")


@query(_SELECT)
def select_flagship(spark, d):
    return _selected(spark, d).select("o_orderkey", "o_custkey", "select_pass", "select_reject_reason")


@query(f"SELECT select_reject_reason, count(*) AS n FROM ({_SELECT}) WHERE select_reject_reason <> '' GROUP BY 1")
def select_reject_counts(spark, d):
    return selection.reject_counts(_selected(spark, d), "select_reject_reason")


@query(f"""WITH s AS (SELECT o_custkey, count(*) n, sum(select_pass) k FROM ({_SELECT}) GROUP BY 1)
SELECT sum(n)::BIGINT candidates, count(*) FILTER (n > 1) "groups", count(*) FILTER (n = 1) singletons, sum(k)::BIGINT kept, (sum(n) - sum(k))::BIGINT rejected FROM s""")
def select_summary(spark, d):
    return selection.select_summary(_selected(spark, d), "o_custkey", "select_pass")


_SCREEN = """SELECT l_orderkey, l_linenumber, concat_ws(';',
  CASE WHEN l_quantity IS NULL OR l_quantity < 5 THEN 'few' WHEN l_quantity > 45 THEN 'many' END,
  CASE WHEN l_discount IS NULL OR l_discount > 0.08::DOUBLE THEN 'discount' END,
  CASE WHEN l_returnflag IS NULL OR l_returnflag <> 'N' THEN 'returned' END) AS screen_reject_reason FROM lineitem"""


def _screened(spark, d):
    tests = [
        rules.Rule("quantity", "l_quantity", min=5, max=45, min_reject_reason="few", max_reject_reason="many"),
        rules.Rule("discount", "l_discount", max=0.08, reject_reason="discount"),
        rules.Rule("flag", "l_returnflag", equals="N", reject_reason="returned"),
    ]
    return rules.check(t(spark, d, "lineitem"), tests, "screen")


@query(f"SELECT *, (screen_reject_reason = '')::BIGINT AS screen_pass FROM ({_SCREEN})")
def rule_screen(spark, d):
    return _screened(spark, d).select("l_orderkey", "l_linenumber", "screen_reject_reason", "screen_pass")


@query(f"SELECT screen_reject_reason, count(*) AS n FROM ({_SCREEN}) WHERE screen_reject_reason <> '' GROUP BY 1")
def reject_reason_counts(spark, d):
    return selection.reject_counts(_screened(spark, d), "screen_reject_reason")


@query(f"SELECT DISTINCT screen_reject_reason FROM ({_SCREEN}) WHERE screen_reject_reason <> ''")
def distinct_reasons(spark, d):
    return selection.distinct_reasons(_screened(spark, d), "screen_reject_reason")


@query(f"SELECT round(count(*) FILTER (screen_reject_reason = '') / count(*)::DOUBLE, 6) AS keep_rate, round(count(*) FILTER (screen_reject_reason <> '') / count(*)::DOUBLE, 6) AS reject_rate FROM ({_SCREEN})")
def keep_rates(spark, d):
    s = _screened(spark, d)
    return s.select(F.col("screen_pass"), (1 - F.col("screen_pass")).alias("r")).agg(profile.rate(F.col("screen_pass")).alias("keep_rate"), profile.rate(F.col("r")).alias("reject_rate"))


@query("""SELECT event_id, CASE WHEN k IS NULL THEN 'low' WHEN k < 20 THEN 'low' WHEN k > 80 THEN 'high' ELSE '' END AS k_reject_reason, (k BETWEEN 20 AND 80)::BIGINT AS k_pass
FROM (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) k FROM events)""")
def rule_json_field(spark, d):
    r = rules.Rule("k", "props.k", min=20, max=80, min_reject_reason="low", max_reject_reason="high")
    return rules.check(t(spark, d, "events"), [r], "k").select("event_id", "k_reject_reason", "k_pass")


@query("""SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'select_pass' WHEN p_size < 5 THEN 'duration_below_min' WHEN p_size > 40 THEN 'duration_above_max'
 WHEN p_retailprice * p_size < 10000 THEN 'resolution_below_min' WHEN p_retailprice * p_size > 50000 THEN 'resolution_above_max' END AS reason FROM part""")
def priority_reject(spark, d):
    p = t(spark, d, "part")
    flag = F.when(F.col("p_size") % 7 != 0, 1).otherwise(0)
    return p.select("p_partkey", sampling.packing_reject(F.col("p_size"), F.col("p_retailprice"), F.col("p_size"), flag, 5, 40, 10000, 50000).alias("reason"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 20 AND l_discount > 0.05::DOUBLE")
def score_threshold_filter(spark, d):
    return rules.threshold_filter(t(spark, d, "lineitem"), l_quantity=("lt", 20), l_discount=("gt", 0.05)).select("l_orderkey", "l_linenumber")


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'token') OR contains(lower(source), 'token')")
def keyword_filter(spark, d):
    return rules.keyword_filter(t(spark, d, "documents"), "TOKEN", ["text", "source"]).select("doc_id")


@query("SELECT c_custkey, CASE WHEN c_nationkey IS NOT NULL AND c_custkey IS NOT NULL THEN least(c_nationkey, c_custkey) END AS short_side FROM customer")
def short_side(spark, d):
    return t(spark, d, "customer").select("c_custkey", rules.short_side(F.col("c_nationkey").cast("long"), F.col("c_custkey")).alias("short_side"))


# --- scales and frame scores -------------------------------------------------------------------------------

@query("""SELECT p_partkey,
 round(CASE WHEN p_retailprice <= 950 OR p_retailprice >= 1900 THEN 0 WHEN p_retailprice < 1100 THEN (p_retailprice - 950) / 150 WHEN p_retailprice > 1500 THEN (1900 - p_retailprice) / 400 ELSE 1 END, 6)::DOUBLE AS trapezoid,
 round(greatest(0, least(1, (p_size - 5) / 30.0::DOUBLE)), 6) AS growth, round(1 - greatest(0, least(1, (p_size - 5) / 30.0::DOUBLE)), 6) AS decay,
 round(CASE WHEN p_size <= 0 THEN 0 ELSE 1 - exp(-ln(2::DOUBLE) * p_size / 8) END, 6)::DOUBLE AS saturation FROM part""")
def scale_functions(spark, d):
    price, size = F.col("p_retailprice"), F.col("p_size").cast("double")
    return t(spark, d, "part").select(
        "p_partkey", F.round(S.trapezoid_scale(price, 950, 1100, 1500, 1900), 6).alias("trapezoid"), F.round(S.linear_growth(size, 5, 35), 6).alias("growth"),
        F.round(S.linear_decay(size, 5, 35), 6).alias("decay"), F.round(S.exp_saturation(size, 8), 6).alias("saturation"),
    )


_GROWN = "greatest(0, least(1, (l_quantity - 1) / 49.0::DOUBLE))"


@query(f"""SELECT l_orderkey, round(quantile_cont({_GROWN}, 0.2::DOUBLE), 6) AS score, round(quantile_cont({_GROWN}, 0.5::DOUBLE), 6) AS median,
 round(avg({_GROWN}), 6) AS mean, count(*) AS frame_count FROM lineitem GROUP BY 1""")
def frame_quantile_score(spark, d):
    s = t(spark, d, "lineitem").select("l_orderkey", S.linear_growth(F.col("l_quantity"), 1, 50).alias("s"))
    return profile.quantile_scores(s, "l_orderkey", "s", 0.2)


@query("""SELECT l_orderkey, round(avg(l_quantity), 6) AS motion_mean, max(l_discount) AS cut_max, round(avg((l_discount >= 0.05::DOUBLE)::INT), 6) AS cut_ratio FROM lineitem GROUP BY 1""")
def motion_summary(spark, d):
    return profile.motion_summary(t(spark, d, "lineitem"), "l_orderkey", "l_quantity", "l_discount", 0.05)


@query("""WITH m AS (SELECT l_orderkey, avg(l_quantity) mm, avg((l_discount >= 0.1::DOUBLE)::INT) cr FROM lineitem GROUP BY 1)
SELECT l_orderkey, round((1 - exp(-ln(2::DOUBLE) * mm / 8)) * (1 - greatest(0, least(1, cr / 0.05::DOUBLE))), 6) AS motion_score FROM m""")
def motion_score(spark, d):
    m = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.avg("l_quantity").alias("mm"), F.avg((F.col("l_discount") >= 0.1).cast("int")).alias("cr"))
    return m.select("l_orderkey", F.round(S.motion_score(F.col("mm"), F.col("cr")), 6).alias("motion_score"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])))), 5) AS total FROM embeddings")
def l2_normalise(spark, d):
    u = S.l2_normalised(F.col("embedding"))
    return t(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(u, F.lit(0.0), lambda s, x: s + x), 5).alias("total"))


@query("SELECT l_orderkey, l_linenumber, round(l_quantity + l_tax + l_discount + l_extendedprice, 4) AS score FROM lineitem")
def select_score(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(selection.select_score(*map(F.col, ("l_quantity", "l_tax", "l_discount", "l_extendedprice"))), 4).alias("score"))


# --- profiles ----------------------------------------------------------------------------------------------

@query("""WITH s AS (SELECT 'customer' score, (c_acctbal + 1000) / 11000 v FROM customer)
SELECT score, count(v) AS valid, count(*) FILTER (v IS NULL) AS missing, round(avg(v), 6) AS mean, round(min(v), 6) AS min, round(max(v), 6) AS max,
""" + ", ".join(f"count(*) FILTER (least(floor(v / (1.0::DOUBLE / 12)), 11) = {i}) AS bin_{i}" for i in range(12)) + " FROM s GROUP BY score")
def score_overview(spark, d):
    return profile.score_overview(t(spark, d, "customer").select(((F.col("c_acctbal") + 1000) / 11000).alias("customer")), ["customer"])


@query("""WITH b(bin, low, high) AS (VALUES (0, 0::DOUBLE, 1000::DOUBLE), (1, 1000, 2500), (2, 2500, 5000), (3, 5000, 10000))
SELECT bin::INT AS bin, low, high, count(*) AS n FROM b JOIN supplier ON s_acctbal >= low AND s_acctbal < high GROUP BY ALL""")
def score_histogram(spark, d):
    return profile.histogram(t(spark, d, "supplier"), F.col("s_acctbal"), [0, 1000, 2500, 5000, 10000])


@query("""WITH b(bin, low, high) AS (VALUES (0, 0::DOUBLE, 64::DOUBLE), (1, 64, 512), (2, 512, 1024), (3, 1024, 4096), (4, 4096, 1000000), (5, 1000000, 2000000))
SELECT bin::INT AS bin, low, high, count(doc_id) AS n FROM b LEFT JOIN documents ON n_chars > low AND n_chars <= high GROUP BY ALL""")
def length_histogram(spark, d):
    return profile.histogram(t(spark, d, "documents"), F.col("n_chars"), [0, 64, 512, 1024, 4096, 1000000, 2000000], closed=True, fill=True)


@query("SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 7")
def topk_value_counts(spark, d):
    return profile.value_counts(t(spark, d, "part"), "p_brand", 7)


@query("SELECT lang, source, count(*) AS count, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS ratio FROM documents GROUP BY lang, source")
def distribution_summary(spark, d):
    return profile.distribution(t(spark, d, "documents"), "lang", "source")


@query("SELECT lang, round(avg(n_chars), 3) AS mean, round(quantile_cont(n_chars, 0.95::DOUBLE), 3) AS p95, round(quantile_cont(n_chars, 0.99::DOUBLE), 3) AS p99 FROM documents GROUP BY lang")
def length_percentiles(spark, d):
    return profile.percentile_summary(t(spark, d, "documents"), "n_chars", [0.95, 0.99], "lang")


@query("""SELECT CASE WHEN grouping(r) = 0 THEN r END AS resolution, CASE WHEN grouping(f) = 0 THEN f END AS frames, count(*) AS n, (2 * grouping(r) + grouping(f))::INT AS level
FROM (SELECT (p_size % 5) || 'x' || (p_size % 3) r, p_size % 4 f FROM part) GROUP BY GROUPING SETS ((r), (f), (r, f))""")
def resolution_profile(spark, d):
    p = t(spark, d, "part").select((F.col("p_size") % 5).alias("w"), (F.col("p_size") % 3).alias("h"), (F.col("p_size") % 4).alias("f"))
    return profile.resolution_profile(p, "w", "h", "f")


@query("""SELECT CASE WHEN s < 360 THEN '<360' WHEN s < 480 THEN '360-479' WHEN s < 720 THEN '480-719' WHEN s < 1080 THEN '720-1079' ELSE '>=1080' END AS bucket, count(*) AS n
FROM (SELECT p_size * 30 s FROM part) GROUP BY 1""")
def short_side_buckets(spark, d):
    return t(spark, d, "part").groupBy(profile.short_side_bucket(F.col("p_size") * 30).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS mean FROM lineitem GROUP BY 1")
def weighted_mean(spark, d):
    return profile.weighted_mean(t(spark, d, "lineitem"), "l_discount", "l_quantity", "l_returnflag")


@query("""SELECT md5(text) AS digest, count(*) AS size, count(DISTINCT source) AS sources, min(doc_id) AS first_id, (count(DISTINCT source) > 1)::INT AS cross_source FROM documents GROUP BY 1 HAVING count(*) > 1""")
def group_rollup(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("digest"))
    return profile.group_rollup(docs, "digest", "doc_id", "source")


@query("""SELECT digest FROM (SELECT md5(text) AS digest, count(*) n, count(DISTINCT source) s FROM documents GROUP BY 1) WHERE n BETWEEN 2 AND 10 AND s > 1""")
def cross_source_groups(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("digest"))
    return profile.group_rollup(docs, "digest", "doc_id", "source").where("size between 2 and 10 and cross_source = 1").select("digest")


@query("SELECT size, count(*) AS groups, sum(size)::BIGINT AS members FROM (SELECT count(*) size FROM documents GROUP BY md5(text)) GROUP BY size")
def group_size_dist(spark, d):
    return profile.group_sizes(t(spark, d, "documents").select(F.md5("text").alias("digest")), "digest")


@query("SELECT count(DISTINCT c_nationkey) AS groups, count(*) AS clips, sum(CASE WHEN b < 0 THEN 0 ELSE b END)::BIGINT AS total FROM (SELECT c_nationkey, floor(c_acctbal)::BIGINT AS b FROM customer)")
def unique_counts(spark, d):
    return profile.unique_totals(t(spark, d, "customer").select("c_nationkey", F.floor("c_acctbal").alias("b")), "c_nationkey", "b")


# --- timelines ---------------------------------------------------------------------------------------------

_TICKS = """t AS (SELECT DISTINCT user_id, round(epoch(ts) % 86400, 6)::DOUBLE AS s FROM events),
r AS (SELECT user_id, (row_number() OVER w - 1)::INT AS range_index, s AS start_sec, lead(s) OVER w AS end_sec FROM t WINDOW w AS (PARTITION BY user_id ORDER BY s))"""


def _ticks(spark, d):
    e = t(spark, d, "events").select("user_id", F.round((F.unix_micros(F.col("ts").cast("timestamp")) % 86400000000) / 1e6, 6).alias("s"))
    return e.groupBy("user_id").agg(F.collect_list("s").alias("ticks"))


@query(f"WITH {_TICKS} SELECT user_id, range_index, start_sec, end_sec, (count(*) OVER (PARTITION BY user_id))::INT AS num_ranges FROM r WHERE end_sec IS NOT NULL")
def ticks_to_ranges(spark, d):
    return timeline.tick_ranges(_ticks(spark, d), "user_id", "ticks")


@query(f"""WITH {_TICKS}, q AS (SELECT *, CASE WHEN end_sec - start_sec > 3600 + 1e-6 THEN ceil((end_sec - start_sec - 1e-6) / 1800)::INT ELSE 1 END n FROM r WHERE end_sec IS NOT NULL),
p AS (SELECT user_id, range_index, i::INT AS split_index, start_sec + i * 1800 AS a, CASE WHEN i = n - 1 THEN end_sec ELSE start_sec + i * 1800 + 1800 END AS b FROM (SELECT *, unnest(generate_series(0, n - 1)) i FROM q)),
w AS (SELECT *, (row_number() OVER z - 1)::INT AS clip_index, lag(range_index) OVER z pr, lag(b - a) OVER z pl, lead(range_index) OVER z nr, lead(b - a) OVER z nl FROM p WINDOW z AS (PARTITION BY user_id ORDER BY range_index, split_index)),
c AS (SELECT user_id, clip_index, split_index, round(a + CASE WHEN pr <> range_index AND b - a > 20 + 1e-6 AND pl > 20 + 1e-6 THEN 10 ELSE 0 END, 6) AS start_sec,
  round(b - CASE WHEN nr <> range_index AND b - a > 20 + 1e-6 AND nl > 20 + 1e-6 THEN 10 ELSE 0 END, 6) AS end_sec FROM w)
SELECT * FROM c WHERE end_sec > start_sec AND end_sec - start_sec >= 60 - 1e-6""")
def clip_timings(spark, d):
    return timeline.clip_timings(_ticks(spark, d), "user_id", "ticks", 60.0, 3600.0, 1800.0, 10.0)


@query("""SELECT o_orderkey, i::INT AS range_index, (i * 30000)::DOUBLE AS start_sec, ((i + 1) * 30000)::DOUBLE AS end_sec
FROM (SELECT o_orderkey, unnest(generate_series(0, floor((o_totalprice + 1e-9) / 30000)::INT - 1)) i FROM orders)""")
def uniform_ranges(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.posexplode(timeline.uniform_ranges(F.col("o_totalprice"), 30000.0)).alias("range_index", "r"))
    return o.select("o_orderkey", "range_index", F.col("r.start").alias("start_sec"), F.col("r.stop").alias("end_sec"))


@query("""SELECT user_id, event_id, edge FROM (SELECT user_id, event_id, (CASE WHEN value > 50 THEN 1 ELSE 0 END - coalesce(lag(CASE WHEN value > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0))::INT AS edge FROM events) WHERE edge <> 0""")
def scene_edges(spark, d):
    return timeline.scene_edges(t(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("value") > 50).select("user_id", "event_id", "edge")


@query("""WITH a AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) island FROM a)
SELECT user_id, island::BIGINT AS island, event_type, count(*) AS n, count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS failed, min(event_id) FILTER (event_type = 'error')::VARCHAR AS first_error FROM b GROUP BY ALL""")
def gap_islands(spark, d):
    err = F.when(F.col("event_type") == "error", F.col("event_id").cast("string"))
    e = t(spark, d, "events")
    out = profile.consecutive_rollup(e, ["ts", "event_id"], "event_type", "user_id", F.col("event_type") != "error", err)
    return out.select("user_id", "island", "event_type", "n", "ok", "failed", "first_error")


@query("""WITH u AS (SELECT user_id, max(value) * 10 dur FROM events GROUP BY 1),
t AS (SELECT user_id, round(least(greatest(value, 0), dur), 6) s FROM events JOIN u USING (user_id) UNION SELECT user_id, 0 FROM u UNION SELECT user_id, round(dur, 6) FROM u),
r AS (SELECT user_id, lead(s) OVER (PARTITION BY user_id ORDER BY s) - s l FROM t)
SELECT user_id, count(l)::INT AS n, (count(*) FILTER (l > 10))::INT AS long, (count(*) FILTER (l < 2))::INT AS short, round(avg(l), 4) AS mean_len FROM r GROUP BY 1""")
def range_stats(spark, d):
    u = t(spark, d, "events").groupBy("user_id").agg(F.collect_list("value").alias("ticks"), (F.max("value") * 10).alias("dur"))
    return timeline.range_stats(u, "user_id", "ticks", "dur").withColumn("mean_len", F.round("mean_len", 4))


@query("""SELECT CASE WHEN l < 2 THEN '<2s' WHEN l <= 10 THEN '2~10s' ELSE '>10s' END AS bucket, count(*) AS n FROM (SELECT l_quantity / 4 l FROM lineitem) GROUP BY 1""")
def duration_buckets(spark, d):
    return t(spark, d, "lineitem").groupBy(timeline.duration_bucket(F.col("l_quantity") / 4).alias("bucket")).agg(F.count("*").alias("n"))


# --- similarity and groups ---------------------------------------------------------------------------------

_COS = "SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id"
_EDGES = f"e AS (SELECT a, b, cosine FROM ({_COS}) WHERE cosine >= 0.4)"
_COMP = f"""WITH RECURSIVE {_EDGES}, s AS (SELECT a x, b y FROM e UNION SELECT b, a FROM e),
c(node, root) AS (SELECT x, x FROM s UNION SELECT s.y, c.root FROM c JOIN s ON s.x = c.node),
l AS (SELECT node, min(root) AS component FROM c GROUP BY node)"""


@query(f"SELECT a, b, round(cosine, 6) AS cosine FROM ({_COS}) WHERE cosine >= 0.4")
def cosine_pairs(spark, d):
    return similarity.cosine_pairs(t(spark, d, "embeddings"), 0.4).withColumn("cosine", F.round("cosine", 6))


@query("""WITH p AS (SELECT a.vec_id id, b.vec_id neighbour, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) c FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT id, rank, neighbour FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, neighbour)::INT AS rank FROM p) WHERE rank <= 5""")
def cosine_topk(spark, d):
    return similarity.cosine_top_k(t(spark, d, "embeddings"), 5).select("id", "rank", "neighbour")


_CODE = "SELECT vec_id AS id, list_reduce(list_transform(list_reverse(embedding[1:63]), lambda x: CASE WHEN x > 0 THEN 1::BIGINT ELSE 0::BIGINT END), lambda s, b: s * 2 + b) AS code FROM embeddings"


def _codes(spark, d):
    return t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), similarity.sign_code("embedding").alias("code"))


@query(f"WITH c AS ({_CODE}) SELECT a.id AS a, b.id AS b, bit_count(xor(a.code, b.code))::INT AS distance FROM c a JOIN c b ON a.id < b.id WHERE bit_count(xor(a.code, b.code)) <= 18")
def hamming_pairs(spark, d):
    return similarity.hamming_pairs(_codes(spark, d), 18, bits=63)


@query(f"""WITH c AS ({_CODE}), p AS (SELECT a.id a, b.id b, bit_count(xor(a.code, b.code)) dist FROM c a JOIN c b ON a.id <> b.id WHERE bit_count(xor(a.code, b.code)) <= 20),
n AS (SELECT a % 50 AS clip_a, b % 50 AS clip_b, a, min(dist) dist FROM p WHERE a % 50 <> b % 50 GROUP BY ALL), s AS (SELECT vec_id % 50 AS clip_a, count(*) f FROM embeddings GROUP BY 1)
SELECT clip_a, clip_b, count(*) AS matched, round(count(*) / max(f)::DOUBLE, 6) AS ratio, round(avg(dist), 6) AS mean_distance FROM n JOIN s USING (clip_a) GROUP BY 1, 2 HAVING count(*) / max(f)::DOUBLE >= 0.2::DOUBLE""")
def frame_ratio_match(spark, d):
    pairs = similarity.hamming_pairs(_codes(spark, d), 20, bits=63)
    frames = t(spark, d, "embeddings").select(F.col("vec_id").alias("frame"), (F.col("vec_id") % 50).alias("clip"))
    return similarity.frame_ratio_match(pairs, frames, 0.2).withColumn("ratio", F.round("ratio", 6))


def _pairs(spark, d):
    return graph.durable(similarity.cosine_pairs(t(spark, d, "embeddings"), 0.4))


@query(f"{_COMP} SELECT node, component FROM l")
def components_cosine(spark, d):
    return graph.components(_pairs(spark, d))


@query(f"{_COMP} SELECT component, 'cosine-' || lpad((row_number() OVER (ORDER BY component))::VARCHAR, 6, '0') AS group_id FROM (SELECT DISTINCT component FROM l)")
def dup_groups_numbered(spark, d):
    return graph.numbered_groups(graph.components(_pairs(spark, d)), "cosine")


@query(f"{_COMP} SELECT component, arg_min(node, (-label * 100000 + node)) AS best_id, count(*) AS size FROM l JOIN embeddings ON node = vec_id GROUP BY 1")
def best_in_group(spark, d):
    rows = graph.components(_pairs(spark, d)).join(t(spark, d, "embeddings").select(F.col("vec_id").alias("node"), "label"), "node")
    return selection.best_in_group(rows, "component", [-F.col("label")], "node")


@query(f"WITH {_EDGES}, s AS (SELECT a id, b m, round(cosine, 6) c FROM e UNION ALL SELECT b, a, round(cosine, 6) FROM e) SELECT id, match, cosine FROM (SELECT id, m AS match, c AS cosine, row_number() OVER (PARTITION BY id ORDER BY c DESC, m DESC) rn FROM s) WHERE rn = 1")
def best_match(spark, d):
    return similarity.best_match(similarity.cosine_pairs(t(spark, d, "embeddings"), 0.4).withColumn("cosine", F.round("cosine", 6)), "cosine")


# --- labels ------------------------------------------------------------------------------------------------

_DOMAIN = ["view", "click", "purchase", "signup", "refund", "error"]


@query("""WITH dom(label) AS (VALUES """ + ", ".join(f"('{x}')" for x in _DOMAIN) + """), c AS (SELECT event_type AS label, count(*) n FROM events GROUP BY 1)
SELECT label, coalesce(n, 0)::BIGINT AS n, round(100.0::DOUBLE * coalesce(n, 0) / (SELECT count(*) FROM events), 2) AS percent FROM dom LEFT JOIN c USING (label)""")
def label_counts(spark, d):
    return labels.label_counts(t(spark, d, "events"), F.array("event_type"), _DOMAIN)


@query("SELECT event_id, CASE WHEN TRY_CAST(k AS INT) BETWEEN 0 AND 49 THEN '' ELSE 'bad k' END AS error, CASE WHEN TRY_CAST(k AS INT) BETWEEN 0 AND 49 THEN k ELSE 'unknown' END AS k FROM (SELECT event_id, json_extract_string(props, '$.k') k FROM events)")
def label_validate(spark, d):
    schema = labels.LabelSchema(single={"k": [str(i) for i in range(50)]})
    e = t(spark, d, "events")
    return e.select("event_id", schema.checked(F.col("props")).alias("c")).select("event_id", F.coalesce("c.error", F.lit("")).alias("error"), "c.labels.k")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events WHERE event_type <> 'error') WHERE rn = 1")
def latest_success(spark, d):
    return selection.latest(t(spark, d, "events").where("event_type <> 'error'"), "user_id", [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type")


# --- joins -------------------------------------------------------------------------------------------------

@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def resume_anti(spark, d):
    done = t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.resume(t(spark, d, "orders").select("o_orderkey"), done, "o_orderkey", F.col("l_returnflag") == "R")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def exclude_ids(spark, d):
    out = t(spark, d, "customer").where("c_mktsegment = 'BUILDING'").withColumnRenamed("c_custkey", "o_custkey")
    return joins.exclude(t(spark, d, "orders"), out, "o_custkey").select("o_orderkey")


@query("SELECT c_custkey * 2 AS o_orderkey, (c_custkey * 7919) % 1009 AS position, o_totalprice FROM customer JOIN orders ON o_orderkey = c_custkey * 2")
def ordered_id_fetch(spark, d):
    wanted = t(spark, d, "customer").select((F.col("c_custkey") * 2).alias("o_orderkey"), ((F.col("c_custkey") * 7919) % 1009).alias("position"))
    return joins.ordered_fetch(t(spark, d, "orders").select("o_orderkey", "o_totalprice"), wanted, "o_orderkey", "position")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def missing_ids(spark, d):
    some = t(spark, d, "orders").where("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey")
    return joins.missing(t(spark, d, "customer"), some, "c_custkey")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)) WHERE rn = 1")
def fetch_latest_of_ids(spark, d):
    wanted = t(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return joins.fetch(t(spark, d, "orders"), wanted, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT user_id, array_to_string(list_distinct_sorted, ',') AS names FROM (SELECT user_id, list_sort(list_distinct(list(event_type))) AS list_distinct_sorted FROM events GROUP BY 1)""")
def set_union_lists(spark, d):
    half = F.col("event_id") % 2 == 0
    e = t(spark, d, "events").groupBy("user_id").agg(F.collect_set(F.when(half, F.col("event_type"))).alias("a"), F.collect_set(F.when(~half, F.col("event_type"))).alias("b"))
    return e.select("user_id", F.array_join(F.array_sort(joins.union_lists(F.col("a"), F.col("b"))), ",").alias("names"))


# --- packing and sampling ----------------------------------------------------------------------------------

@query("""SELECT l_orderkey, l_linenumber, CASE WHEN f >= 49 THEN 49 WHEN f >= 33 THEN 33 WHEN f >= 17 THEN 17 WHEN f >= 5 THEN 5 END::INT AS bucket FROM (SELECT l_orderkey, l_linenumber, floor(l_quantity * 1.5 + 1e-9) f FROM lineitem)""")
def bucket_temporal(spark, d):
    buckets = G.frame_buckets([8, 17, 20, 33, 36, 49], 4)
    buckets = [b for b in buckets if b in (5, 17, 33, 49)]
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", G.bucket_frames(F.col("l_quantity"), F.lit(1.5), buckets).cast("int").alias("bucket"))


@query("""WITH p AS (SELECT p_partkey, (p_size * 40)::DOUBLE w, p_retailprice h FROM part), s AS (SELECT *, CASE WHEN w * h > 409600 THEN sqrt(409600 / (w * h)) ELSE 1 END k FROM p),
b AS (SELECT p_partkey, (floor(w * k / 16) * 16)::INT bw, (floor(h * k / 16) * 16)::INT bh FROM s)
SELECT p_partkey, CASE WHEN bw > 0 AND bh > 0 THEN bw END AS bucket_width, CASE WHEN bw > 0 AND bh > 0 THEN bh END AS bucket_height FROM b""")
def bucket_resolution(spark, d):
    p = t(spark, d, "part").select("p_partkey", G.bucket_resolution(F.col("p_size") * 40, F.col("p_retailprice"), G.pixel_budget(480), 16).alias("b"))
    return p.select("p_partkey", F.col("b.width").alias("bucket_width"), F.col("b.height").alias("bucket_height"))


_ORDER = "((o_orderkey % 2147483647) * 1103515245 + 7) % 2147483647"


@query(f"""WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_ORDER}, o_orderkey) - 1 rn, count(*) OVER (PARTITION BY o_orderpriority) n FROM orders)
SELECT o_orderkey, o_orderpriority, (rn // 32)::BIGINT AS batch, ((rn % 32) // 8)::INT AS rank FROM r WHERE rn < n // 32 * 32""")
def bucket_batches(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.bucket_batches(o, "o_orderpriority", "o_orderkey", sampling.portable_order("o_orderkey", 7), 4, 8)


@query("SELECT o_orderpriority, count(*) AS n, (count(*) // 32 * 32)::BIGINT AS used, (count(*) % 32)::BIGINT AS dropped, (count(*) // 32)::BIGINT AS batches FROM orders GROUP BY 1")
def bucket_totals(spark, d):
    return sampling.bucket_totals(t(spark, d, "orders"), "o_orderpriority", 32)


@query(f"""WITH v AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_ORDER}, o_orderkey) rn FROM orders) WHERE rn <= 20),
w AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_ORDER}, o_orderkey) rn FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM v)) WHERE rn <= 100)
SELECT *, 'val' AS split FROM v UNION ALL SELECT *, 'train' FROM w""")
def split_no_leak(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return sampling.split_without_leaks(o, "o_orderpriority", "o_custkey", "o_orderkey", sampling.portable_order("o_orderkey", 7), 20, 100)


@query("SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 500)::BIGINT AS shard FROM orders")
def metadata_shards(spark, d):
    return sampling.metadata_shards(t(spark, d, "orders").select("o_orderkey"), "o_orderkey", 500)


@query("SELECT source, count(*) AS n, round(1.0::DOUBLE / (SELECT count(DISTINCT source) FROM documents) / count(*), 9) AS weight FROM documents GROUP BY 1")
def mixture_weights(spark, d):
    return sampling.mixture_weights(t(spark, d, "documents"), "source").withColumn("weight", F.round("weight", 9))


@query("SELECT count(*) AS rows, greatest(1, ceil(count(*) / 64.0::DOUBLE))::BIGINT AS steps FROM orders")
def steps_per_epoch(spark, d):
    return t(spark, d, "orders").agg(F.count("*").alias("rows")).select("rows", G.steps_column(F.col("rows"), 8, 8).alias("steps"))


@query("""WITH l AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) a FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_transform(generate_series(0, 3), lambda i: a[round_even(i * (len(a) - 1) / 3.0::DOUBLE, 0)::INT + 1]), ',') AS picked FROM l""")
def uniform_pick(spark, d):
    rows = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("a"))
    return rows.select("l_orderkey", F.array_join(G.uniform_pick(F.col("a"), 4), ",").alias("picked"))


@query("SELECT printf('%s:clip:%05d:%02d', 'video-' || o_custkey, o_orderkey % 100000, o_orderkey % 7) AS clip_id FROM orders")
def clip_id_format(spark, d):
    return t(spark, d, "orders").select(X.clip_id(F.concat(F.lit("video-"), "o_custkey"), F.col("o_orderkey") % 100000, F.col("o_orderkey") % 7).alias("clip_id"))


@query("SELECT 'root/' || substr(sha1(k), 1, 2) || '/' || substr(sha1(k), 3, 2) || '/' || k AS path FROM (SELECT o_orderkey::VARCHAR k FROM orders)")
def bucket_path(spark, d):
    return t(spark, d, "orders").select(X.bucketed_path(F.col("o_orderkey").cast("string"), "root").alias("path"))


@query("SELECT '/data/' || c_custkey || '.mp4 ' || c_nationkey AS value FROM customer WHERE c_acctbal > 0")
def manifest(spark, d):
    c = t(spark, d, "customer").where("c_acctbal > 0").select(F.concat(F.lit("/data/"), "c_custkey", F.lit(".mp4")).alias("p"), "c_nationkey")
    return sampling.manifest_lines(c, "p", "c_nationkey")


@query()
def blake_ids(spark, d):
    o = t(spark, d, "orders")
    return o.select("o_orderkey", X.blake_id(F.lit("orders"), F.col("o_orderpriority"), F.col("o_orderkey").cast("string"), F.lit("")).alias("video_id"))


@query()
def sampled_with_rng(spark, d):
    return sampling.random_ranges(t(spark, d, "orders"), "o_orderkey", "o_totalprice", 3000.0, 2, 500.0, 1)


@query()
def weighted_sample(spark, d):
    return sampling.weighted_sample(t(spark, d, "customer").select("c_custkey", F.greatest("c_acctbal", F.lit(0.0)).alias("w")), "w", 500, 3)


@query("""WITH r AS (SELECT c_custkey, floor(c_acctbal)::DOUBLE AS w FROM customer WHERE floor(c_acctbal) > 0),
l AS (SELECT c_custkey, sum(w) OVER (ORDER BY c_custkey) - w AS a, sum(w) OVER (ORDER BY c_custkey) AS b FROM r),
p AS (SELECT i AS draw, (((i + 1) % 2147483647) * 1103515245 + 3) % 2147483647 / 2147483647.0::DOUBLE * (SELECT sum(w) FROM r) AS pt FROM range(0, 500) x(i))
SELECT draw, (draw % 4)::INT AS rank, c_custkey FROM p JOIN l ON pt >= a AND pt < b""")
def weighted_draws(spark, d):
    return sampling.weighted_draws(t(spark, d, "customer").select("c_custkey", F.floor("c_acctbal").alias("w")), "w", "c_custkey", 500, 3, 4)


# --- frames ------------------------------------------------------------------------------------------------

@query("""SELECT o_orderkey, round(coalesce((abs(o_totalprice - lag(o_totalprice) OVER w) * 1.0::DOUBLE + abs(o_orderkey - lag(o_orderkey) OVER w) * 2.0::DOUBLE) / 3.0::DOUBLE, 0), 6) AS change
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def content_change(spark, d):
    return V.content_change(t(spark, d, "orders"), "o_custkey", "o_orderkey", {"o_totalprice": 1.0, "o_orderkey": 2.0}).select("o_orderkey", "change")


_CLIPS = """WITH o AS (SELECT o_orderkey, o_orderkey % 100 + 10 AS n FROM orders), p AS (SELECT *, n // 2 AS part, (least(24, n) - 1) AS span, CASE WHEN n > 24 THEN n - 24 ELSE 0 END AS hop FROM o),
c AS (SELECT *, unnest([0, 1]) AS c FROM p)"""
#: Frames of a part or span s of which every sixth is taken, padded to four.
_PADDED = "list_transform(range(0, 4), lambda i: CASE WHEN i < {s} // 6 THEN least(floor(CASE WHEN {s} // 6 = 1 THEN 0 WHEN i = {s} // 6 - 1 THEN {s} ELSE i * {s} / ({s} // 6 - 1)::DOUBLE END), {s} - 1)::BIGINT ELSE {s} - 1 END + {at})"
_WHOLE = "list_transform(range(0, 4), lambda i: least(floor(i * 24 / 3.0::DOUBLE), 23)::BIGINT + c * part)"


def _clips(spark, d, overlap):
    o = t(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 100 + 10).cast("int").alias("n"))
    clips = F.posexplode(V.clip_indices(F.col("n"), 4, 6, 2, overlap)).alias("clip", "x")
    return o.select("o_orderkey", clips).select("o_orderkey", "clip", F.array_join("x", ",").alias("indices"))


@query(f"""{_CLIPS} SELECT o_orderkey, c::INT AS clip, array_to_string(CASE WHEN part > 24 THEN {_WHOLE} ELSE {_PADDED.format(s="part", at="c * part")} END, ',') AS indices FROM c""")
def clip_indices(spark, d):
    return _clips(spark, d, False)


@query(f"""{_CLIPS} SELECT o_orderkey, c::INT AS clip, array_to_string(CASE WHEN part > 24 THEN {_WHOLE} ELSE {_PADDED.format(s="span", at="c * hop")} END, ',') AS indices FROM c""")
def clip_indices_overlap(spark, d):
    return _clips(spark, d, True)


@query("""SELECT grouping_id(lang, size, source)::INT AS level, lang AS frames, size AS resolution, source, count(*) AS n, count(len) AS captions, round(avg(len), 3) AS mean_caption
FROM (SELECT lang, (n_chars // 4096)::BIGINT AS size, source, nullif(length(trim(text)), 0) len FROM documents) GROUP BY GROUPING SETS ((lang), (size), (lang, size), (source))""")
def dataset_scan(spark, d):
    docs = t(spark, d, "documents").withColumn("size", F.floor(F.col("n_chars") / 4096))
    return metadata.dataset_scan(docs, "lang", "size", "source", "text")


@query("SELECT l_orderkey, count(DISTINCT l_returnflag) AS buckets FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def mixed_batches(spark, d):
    return metadata.mixed_batches(t(spark, d, "lineitem"), "l_orderkey", "l_returnflag")


# --- scores, paths and texts of clips ----------------------------------------------------------------------

def _trapezoid(v):
    return f"CASE WHEN {v} <= 0.05::DOUBLE OR {v} >= 0.95::DOUBLE THEN 0 WHEN {v} < 0.2::DOUBLE THEN ({v} - 0.05::DOUBLE) / (0.2::DOUBLE - 0.05::DOUBLE) WHEN {v} > 0.8::DOUBLE THEN (0.95::DOUBLE - {v}) / (0.95::DOUBLE - 0.8::DOUBLE) ELSE 1 END"


def _six(v):
    """Six places by the exact value, half to even. DuckDB's round() takes the rounded product with a million, which is another number near ties."""
    return f"format('{{:.6f}}', {v})::DOUBLE"


_FALL = "(1 - greatest(0, least(1, ({v} - 0.05::DOUBLE) / (0.5::DOUBLE - 0.05::DOUBLE))))"


@query(f"""WITH f AS (SELECT l_orderkey, l_quantity / 50::DOUBLE AS b, l_discount::DOUBLE AS k, l_tax::DOUBLE AS w, l_discount::DOUBLE * 3 AS r FROM lineitem),
s AS (SELECT *, {_trapezoid("b")} * {_FALL.format(v="k")} * {_FALL.format(v="w")} AS e, greatest(0, least(1, (r - 0.05::DOUBLE) / (0.25::DOUBLE - 0.05::DOUBLE))) AS c FROM f),
q AS (SELECT l_orderkey, {_six("quantile_cont(e, 0.2::DOUBLE)")} AS exposure, {_six("quantile_cont(c, 0.2::DOUBLE)")} AS contrast, {_six("quantile_cont(b, 0.5::DOUBLE)")} AS brightness FROM s GROUP BY 1)
SELECT *, {_six("exposure * contrast")} AS optical FROM q""")
def optical_score(spark, d):
    f = t(spark, d, "lineitem").select("l_orderkey", (F.col("l_quantity") / 50).cast("double").alias("b"), F.col("l_discount").cast("double").alias("k"), F.col("l_tax").cast("double").alias("w"), (F.col("l_discount").cast("double") * 3).alias("r"))
    return V.optical_scores(f, "l_orderkey", "b", "k", "w", "r").select("l_orderkey", "exposure", "contrast", "brightness", "optical")


@query(f"SELECT o_orderkey, {_six('greatest(0, least(1, 1 - o_totalprice / 400000::DOUBLE))')} AS score FROM orders")
def text_score(spark, d):
    return t(spark, d, "orders").select("o_orderkey", S.exact_round(S.text_score(F.col("o_totalprice") / 400000), 6).alias("score"))


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE round((p_size * 1000)::DOUBLE / (p_partkey % 5 * 250 + 1), 6) END AS fps,
 greatest(1, round_even(p_retailprice / 100::DOUBLE * coalesce(CASE WHEN p_size % 5 = 0 THEN NULL ELSE (p_size * 1000)::DOUBLE / (p_partkey % 5 * 250 + 1) END, 24), 0))::INT AS frames FROM part""")
def frame_rates(spark, d):
    text = F.when(F.col("p_size") % 5 == 0, "0/0").otherwise(F.concat((F.col("p_size") * 1000).cast("string"), F.lit("/"), (F.col("p_partkey") % 5 * 250 + 1).cast("string")))
    p = t(spark, d, "part").select("p_partkey", "p_retailprice", S.frame_rate(text).alias("f"))
    return p.select("p_partkey", F.round("f", 6).alias("fps"), S.seconds_to_frames(F.col("p_retailprice") / 100, F.col("f")).alias("frames"))


@query("""SELECT p_partkey, greatest(1, floor(16 * 1000::DOUBLE / p_retailprice))::INT AS batch,
 (round_even(p_size * 40 * (480 / least(p_size * 40, 720)::DOUBLE) / 2, 0) * 2)::INT AS width, (round_even(720 * (480 / least(p_size * 40, 720)::DOUBLE) / 2, 0) * 2)::INT AS height FROM part""")
def batch_and_size(spark, d):
    p = t(spark, d, "part").select("p_partkey", G.dynamic_batch(16, 1000.0, F.col("p_retailprice")).alias("batch"), G.even_size(F.col("p_size") * 40, F.lit(720), 480).alias("s"))
    return p.select("p_partkey", "batch", "s.width", "s.height")


@query("""WITH k AS (SELECT 'video-' || o_custkey || ':clip:' || o_orderkey AS clip, o_orderkey % 40 + 1 AS f FROM orders),
n AS (SELECT *, regexp_replace(clip, '[^A-Za-z0-9._-]+', '_', 'g') || '-' || substr(sha1(clip), 1, 12) || '.meta' AS name FROM k)
SELECT 'out/' || f || 'f/832x480/' || substr(sha1(name), 1, 2) || '/' || substr(sha1(name), 3, 2) || '/' || name AS path FROM n""")
def cache_path(spark, d):
    clip = F.concat(F.lit("video-"), "o_custkey", F.lit(":clip:"), "o_orderkey")
    return t(spark, d, "orders").select(X.cache_path(clip, (F.col("o_orderkey") % 40 + 1).cast("int"), F.lit(832), F.lit(480), "out").alias("path"))


@query("""SELECT o_orderkey, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%dm %02ds', floor(s / 60)::BIGINT, round_even(s % 60, 0)::BIGINT) ELSE printf('%dh %02dm', floor(s / 3600)::BIGINT, floor((s % 3600) / 60)::BIGINT) END AS elapsed,
 CASE WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN printf('%.2f KB', b / 1024::DOUBLE) ELSE printf('%.2f MB', b / 1048576::DOUBLE) END AS size
FROM (SELECT o_orderkey, (o_orderkey * 7 % 9001 + 0.3::DOUBLE)::DOUBLE AS s, o_orderkey * o_orderkey % 3000000 AS b FROM orders)""")
def human_units(spark, d):
    k = F.col("o_orderkey")
    return t(spark, d, "orders").select("o_orderkey", X.human_seconds(k * 7 % 9001 + 0.3).alias("elapsed"), X.human_bytes(k * k % 3000000).alias("size"))


@query("""WITH l AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) a FROM lineitem GROUP BY 1 HAVING count(*) >= 2)
SELECT l_orderkey, array_to_string(list_transform(generate_series(0, 4), lambda i: a[round_even(i * (len(a) - 1) / 4.0::DOUBLE, 0)::INT + 1]), ',') AS picked FROM l""")
def encoder_pick(spark, d):
    rows = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("a")).where("size(a) >= 2")
    return rows.select("l_orderkey", F.array_join(G.encoder_pick(F.col("a"), 5), ",").alias("picked"))


# --- labels, scopes and summaries --------------------------------------------------------------------------

_TAGGED = """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'real_world' ELSE 'game' END AS domain, CASE WHEN p_partkey % 3 = 0 THEN 'urban' ELSE 'nature' END AS scene, CASE WHEN p_size % 7 = 0 THEN 'anime' ELSE 'cinematic' END AS style,
 'none' AS text, CASE WHEN p_partkey % 4 = 0 THEN 'huge' ELSE 'logo' END AS watermark, CASE WHEN p_partkey % 5 = 0 THEN ['person', 'animal'] ELSE ['vehicle'] END AS subjects, CASE WHEN p_size % 3 = 0 THEN ['talking', 'none'] ELSE ['talking'] END AS actions FROM part"""


def _tagged(spark, d):
    p, k = F.col("p_size"), F.col("p_partkey")
    either = lambda c, a, b: F.when(c, a).otherwise(b)
    cols = [either(p % 2 == 0, "real_world", "game").alias("domain"), either(k % 3 == 0, "urban", "nature").alias("scene"), either(p % 7 == 0, "anime", "cinematic").alias("style"), F.lit("none").alias("text"), either(k % 4 == 0, "huge", "logo").alias("watermark")]
    cols.append(F.when(k % 5 == 0, F.array(F.lit("person"), F.lit("animal"))).otherwise(F.array(F.lit("vehicle"))).alias("subjects"))
    cols.append(F.when(p % 3 == 0, F.array(F.lit("talking"), F.lit("none"))).otherwise(F.array(F.lit("talking"))).alias("actions"))
    return t(spark, d, "part").select("p_partkey", F.to_json(F.struct(*cols)).alias("json"))


@query(f"""SELECT p_partkey, CASE WHEN watermark = 'huge' THEN 'bad watermark' WHEN len(actions) > 1 THEN 'actions mixes an exclusive value' END AS error,
 CASE WHEN error IS NULL THEN domain ELSE 'unknown' END AS tag_domain, CASE WHEN error IS NULL THEN watermark ELSE 'unknown' END AS tag_watermark, CASE WHEN error IS NULL THEN array_to_string(subjects, ',') ELSE 'unknown' END AS tag_subjects FROM ({_TAGGED})""")
def tag_labels(spark, d):
    rows = _tagged(spark, d).select("p_partkey", labels.TAG.checked(F.col("json")).alias("c")).select("p_partkey", "c.error", F.col("c.labels").alias("l"))
    return rows.select("p_partkey", "error", *labels.TAG.flat(F.col("l"), "tag")).select("p_partkey", "error", "tag_domain", "tag_watermark", F.array_join("tag_subjects", ",").alias("tag_subjects"))


@query(f"""WITH g AS (SELECT * FROM ({_TAGGED}) WHERE watermark <> 'huge' AND len(actions) = 1), x AS (
 SELECT 'domain' AS field, domain AS label FROM g UNION ALL SELECT 'scene', scene FROM g UNION ALL SELECT 'style', style FROM g UNION ALL SELECT 'subjects', unnest(subjects) FROM g UNION ALL SELECT 'actions', unnest(actions) FROM g)
SELECT field, label, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM g), 2) AS percent FROM x GROUP BY 1, 2""")
def tag_label_counts(spark, d):
    good = _tagged(spark, d).select(labels.TAG.checked(F.col("json")).alias("c")).where("c.error is null").select(F.col("c.labels").alias("l"))
    return labels.all_label_counts(good, F.col("l"), labels.TAG).where("n > 0 and field in ('domain', 'scene', 'style', 'subjects', 'actions')")


@query(f"SELECT l_orderkey, l_linenumber FROM ({_SCREEN}) WHERE screen_reject_reason <> ''")
def scope_reject(spark, d):
    return selection.scope(_screened(spark, d), "screen_pass", "reject").select("l_orderkey", "l_linenumber")


@query("""WITH a AS (SELECT *, o_totalprice >= 50000 AS alive FROM orders),
r AS (SELECT o_orderkey, alive, row_number() OVER (PARTITION BY alive, o_custkey ORDER BY o_totalprice DESC, o_orderkey) rn, count(*) OVER (PARTITION BY alive, o_custkey) n,
 row_number() OVER (PARTITION BY alive, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) rn2, count(*) OVER (PARTITION BY alive, o_orderpriority) n2 FROM a)
SELECT o_orderkey, alive AND rn <= least(n, greatest(1, ceil(n * 0.2::DOUBLE)::BIGINT), 3) AS by_customer_keep, alive AND rn2 <= least(n2, greatest(2, ceil(n2 * 0.5::DOUBLE)::BIGINT)) AS by_priority_keep FROM r""")
def keep_membership(spark, d):
    methods = [selection.GroupKeep("by_customer", "o_custkey", 0.2, 1, 3), selection.GroupKeep("by_priority", "o_orderpriority", 0.5, 2)]
    return selection.keep_membership(t(spark, d, "orders"), methods, "o_totalprice", "o_orderkey", F.col("o_totalprice") >= 50000).select("o_orderkey", "by_customer_keep", "by_priority_keep")


@query("""SELECT event_id, event_type <> 'error' AND k > 0 AND 'path' || event_id <> '' AS complete FROM (SELECT *, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k FROM events)""")
def complete_rows(spark, d):
    k = F.get_json_object("props", "$.k")
    ok = F.when(F.col("event_type") == "error", "x").otherwise("1")
    return t(spark, d, "events").select("event_id", rules.cached(ok, F.concat(F.lit(" path"), "event_id"), [k], F.lit("[1, 2]")).alias("complete"))


@query(f"""{_COMP} SELECT 'cosine' AS method, (SELECT count(*) FROM e)::BIGINT AS pair_count, count(DISTINCT component)::BIGINT AS group_count, count(*)::BIGINT AS matched_count FROM l
UNION ALL SELECT 'all', (SELECT count(*) FROM e)::BIGINT, count(DISTINCT component)::BIGINT, count(*)::BIGINT FROM l""")
def match_summary(spark, d):
    pairs = _pairs(spark, d)
    groups = graph.components(pairs, nodes=t(spark, d, "embeddings").select(F.col("vec_id").alias("node")))
    return profile.match_summary(pairs.withColumn("method", F.lit("cosine")), groups.withColumn("method", F.lit("cosine")), "method")


@query("""WITH g AS (SELECT md5(text) AS digest, doc_id, source, doc_id % 2 AS best FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY best DESC, doc_id) rn FROM g)
SELECT digest, count(*) AS size, count(DISTINCT source) AS sources, min(CASE WHEN best = 1 THEN doc_id END) AS best_id, string_agg(doc_id::VARCHAR, ',' ORDER BY rn) FILTER (rn <= 3) AS members FROM r GROUP BY 1""")
def group_members(spark, d):
    g = t(spark, d, "documents").select(F.md5("text").alias("digest"), "doc_id", "source", (F.col("doc_id") % 2).alias("best"))
    return profile.group_members(g, "digest", "doc_id", "source", "best", 3).withColumn("members", F.array_join("members", ","))


@query("SELECT lang, (n_chars // 2048)::BIGINT AS size, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY ALL")
def bucket_index(spark, d):
    items = t(spark, d, "documents").select("lang", F.floor(F.col("n_chars") / 2048).alias("size"), F.col("doc_id").alias("id"))
    return sampling.bucket_index(items, ["lang", "size"], 2).select("lang", "size", "n", F.col("first")[0].alias("first_id"))


@query("SELECT o_orderpriority, count(*) AS n, ((count(*) + 31) // 32 * 32)::BIGINT AS used, 0::BIGINT AS dropped, ((count(*) + 31) // 32)::BIGINT AS batches FROM orders GROUP BY 1")
def bucket_totals_wrapped(spark, d):
    return sampling.bucket_totals(t(spark, d, "orders"), "o_orderpriority", 32, wrap=True)


@query("""SELECT CASE WHEN trim(coalesce(f, '')) = '' THEN 'unknown' ELSE f END AS fps, count(*) AS n FROM (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE (l_tax * 100)::INT::VARCHAR || CASE WHEN l_linenumber = 1 THEN '.5' ELSE '' END END AS f FROM lineitem) GROUP BY 1""")
def fps_counts(spark, d):
    f = F.when(F.col("l_linenumber") != 7, F.round(F.col("l_tax") * 100).cast("double") + F.when(F.col("l_linenumber") == 1, 0.5).otherwise(0.0))
    return t(spark, d, "lineitem").groupBy(profile.rate_text(f).alias("fps")).agg(F.count("*").alias("n"))


@query("""SELECT 'o_comment' AS "column", count(*) FILTER (trim(coalesce(c, '')) = '') AS missing, 0::BIGINT AS invalid FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE 'x' END c FROM orders)
UNION ALL SELECT 'balance', count(*) FILTER (o_orderkey % 5 = 0), count(*) FILTER (o_orderkey % 5 <> 0 AND o_totalprice <= 100000) FROM orders""")
def dataset_problems(spark, d):
    o = t(spark, d, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise("x").alias("o_comment"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") - 100000).alias("balance"))
    return metadata.dataset_problems(o, ["o_comment"], ["balance"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def page_of_rows(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("down"))
    return profile.page(o, ["down", "o_orderkey"], 2, 50).select("o_orderkey", "o_totalprice")


@query("""SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 2""")
def top_per_key(spark, d):
    return profile.top_windowed(t(spark, d, "orders"), "o_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")], 2).select("o_custkey", "o_orderkey", "rank")


@query("""SELECT count(*) AS output, count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS failed FROM events""")
def run_stats(spark, d):
    e = t(spark, d, "events").withColumn("step_ok", (F.col("event_type") != "error").cast("int"))
    return profile.run_stats(e, "step")[0]


# --- nearest neighbours ------------------------------------------------------------------------------------

_WIDE = "SELECT c_custkey AS id, [xor((((c_custkey // 8) * 4 + i) * 1103515245 + 12345) % 2147483647, (1::BIGINT << ((c_custkey % 8) * 3 + i)::INT)) FOR i IN [0, 1, 2, 3]] AS code FROM customer"


def _wide_codes(spark, d):
    k = F.col("c_custkey")
    word = lambda i: ((F.floor(k / 8) * 4 + i) * 1103515245 + 12345) % 2147483647
    return t(spark, d, "customer").select(k.alias("id"), F.array(*[word(i).bitwiseXOR(F.expr(f"shiftleft(1L, cast((c_custkey % 8) * 3 + {i} as int))")) for i in range(4)]).alias("code"))


@query(f"""WITH v AS ({_WIDE}), p AS (SELECT x.id AS a, y.id AS b, (bit_count(xor(x.code[1], y.code[1])) + bit_count(xor(x.code[2], y.code[2])) + bit_count(xor(x.code[3], y.code[3])) + bit_count(xor(x.code[4], y.code[4])))::INT AS distance FROM v x JOIN v y ON x.id <> y.id)
SELECT a, b, distance FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY distance, b) rn FROM p WHERE distance <= 31) WHERE rn <= 5""")
def hamming_matches_256(spark, d):
    return similarity.hamming_matches(_wide_codes(spark, d), 31, 5).withColumn("distance", F.col("distance").cast("int"))


@query("""WITH p AS (SELECT a.vec_id id, b.vec_id neighbour, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) c FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, neighbour) rn FROM p)
SELECT least(id, neighbour) AS a, greatest(id, neighbour) AS b, round(max(c), 6) AS cosine FROM n WHERE rn <= 3 AND c >= 0.35 GROUP BY 1, 2""")
def cosine_matches(spark, d):
    return similarity.cosine_matches(t(spark, d, "embeddings"), 4, 0.35)


@query("""WITH p AS (SELECT l_suppkey % 50 AS x, l_partkey % 50 AS y, l_quantity AS q, l_orderkey * 10 + l_linenumber AS k FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY least(x, y), greatest(x, y) ORDER BY q DESC, k DESC) rn FROM p WHERE x <> y)
SELECT least(x, y) AS a, greatest(x, y) AS b, k FROM r WHERE rn = 1""")
def strongest_pairs(spark, d):
    p = t(spark, d, "lineitem").select((F.col("l_suppkey") % 50).alias("a"), (F.col("l_partkey") % 50).alias("b"), "l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k")).where("a <> b")
    return similarity.strongest(p, [F.col("l_quantity"), F.col("k")]).select("a", "b", "k")


# --- timelines row by row, cuts, orders of browsing --------------------------------------------------------

def _tick_rows(spark, d):
    return t(spark, d, "events").select("user_id", F.round((F.unix_micros(F.col("ts").cast("timestamp")) % 86400000000) / 1e6, 6).alias("s"))


_RANGE_ROWS = f"WITH {_TICKS} SELECT user_id, range_index, start_sec, end_sec FROM r WHERE end_sec IS NOT NULL"


@query(_RANGE_ROWS)
def tick_rows_to_ranges(spark, d):
    return fanout.fold_ticks(_tick_rows(spark, d), "user_id", "s")


@query(_RANGE_ROWS)
def tick_ranges_function(spark, d):
    fanout.register(spark)
    name = f"ticks_{uuid.uuid4().hex}"
    _tick_rows(spark, d).createOrReplaceTempView(name)
    return spark.sql(f"SELECT * FROM tick_ranges(TABLE(SELECT user_id, s FROM {name}))")


@query("""WITH RECURSIVE e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS n FROM events WHERE value > 0 AND value < 100),
k AS (SELECT user_id, 0::BIGINT AS n, 0::DOUBLE AS last, false AS kept FROM (SELECT DISTINCT user_id FROM e)
 UNION ALL SELECT k.user_id, e.n, CASE WHEN e.value - k.last >= 15 THEN e.value ELSE k.last END, e.value - k.last >= 15 FROM k JOIN e ON e.user_id = k.user_id AND e.n = k.n + 1)
SELECT user_id, count(*) AS cuts, round(sum(last), 6) AS total FROM k WHERE kept AND 100 - last >= 15 GROUP BY 1""")
def short_scenes(spark, d):
    cuts = t(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.col("value").cast("double"))).alias("v"))
    kept = cuts.select("user_id", timeline.suppress_short(F.col("v"), 15.0, F.lit(100.0)).alias("k")).where("size(k) > 0")
    return kept.select("user_id", F.size("k").cast("long").alias("cuts"), F.round(F.aggregate("k", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query("SELECT o_orderkey, rn::BIGINT AS place FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) - 1 AS rn FROM orders) WHERE rn BETWEEN 200 AND 299")
def shuffled_page(spark, d):
    rows = profile.page(t(spark, d, "orders").select("o_orderkey", profile.browse_order("o_orderkey", 7).alias("h")), ["h", "o_orderkey"], 2, 100)
    return rows.select("o_orderkey", (F.row_number().over(Window.orderBy("h", "o_orderkey")) + 199).cast("long").alias("place"))  # of one page


@query("""SELECT o_orderkey, CASE WHEN n > 0 THEN (n + 1)::INT ELSE 0 END AS ticks, CASE WHEN n > 0 THEN (n * 30000)::DOUBLE END AS last, greatest(0, least(n, ceil(o_totalprice / 2 / 30000)::INT - 1))::INT AS inner_ticks
FROM (SELECT o_orderkey, o_totalprice, floor((o_totalprice + 1e-9) / 30000)::INT AS n FROM orders)""")
def range_ticks(spark, d):
    ticks = timeline.ranges_to_ticks(timeline.uniform_ranges(F.col("o_totalprice"), 30000.0))
    rows = t(spark, d, "orders").select("o_orderkey", "o_totalprice", ticks.alias("x"))
    return rows.select("o_orderkey", F.size("x").alias("ticks"), F.try_element_at("x", F.lit(-1)).alias("last"), F.size(timeline.inner_times(F.col("x"), F.col("o_totalprice") / 2)).alias("inner_ticks"))


# --- camera labels, parts of a dataset, neighbours with the row itself --------------------------------------

_CAMERA = """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'no-motion' WHEN 1 THEN 'minor-motion' WHEN 2 THEN 'simple-motion' WHEN 3 THEN 'complex-motion' WHEN 4 THEN 'unknown' ELSE 'wild' END AS motion,
 CASE WHEN p_partkey % 5 = 0 THEN 'camera_v0' ELSE 'camera_v1' END AS version, CASE WHEN p_partkey % 7 = 0 THEN ['none', 'motion-blur'] WHEN p_partkey % 7 = 1 THEN ['none'] ELSE ['motion-blur', 'dolly-zoom', 'motion-blur'] END AS effects,
 CASE WHEN p_partkey % 11 = 0 THEN 'roll-CW ' ELSE 'roll-CW' END AS roll FROM part"""


@query(f"""SELECT p_partkey, CASE WHEN motion = 'wild' THEN 'bad motion_type' WHEN version = 'camera_v0' THEN 'bad label_version' WHEN roll <> 'roll-CW' THEN 'bad rotation.roll' WHEN p_partkey % 7 = 0 THEN 'effects mixes an exclusive value' END AS error,
 CASE WHEN e THEN 'unknown' ELSE motion END AS motion_type, CASE WHEN e THEN 'unknown' ELSE 'tilt-up' END AS tilt, CASE WHEN e THEN 'unknown' WHEN p_partkey % 7 = 1 THEN 'none' ELSE 'motion-blur,dolly-zoom' END AS effects, 'camera_v1' AS label_version
FROM (SELECT *, motion = 'wild' OR version = 'camera_v0' OR roll <> 'roll-CW' OR p_partkey % 7 = 0 AS e FROM ({_CAMERA}))""")
def camera_labels(spark, d):
    k = F.col("p_partkey")
    motion = F.element_at(F.array(*map(F.lit, ["no-motion", "minor-motion", "simple-motion", "complex-motion", "unknown", "wild"])), F.col("p_size") % 6 + 1)
    effects = F.when(k % 7 == 0, F.array(F.lit("none"), F.lit("motion-blur"))).when(k % 7 == 1, F.array(F.lit("none"))).otherwise(F.array(F.lit("motion-blur"), F.lit("dolly-zoom"), F.lit("motion-blur")))
    own = {"motion_type": motion, "label_version": F.when(k % 5 == 0, "camera_v0").otherwise("camera_v1"), "prompt_version": F.lit("camera_qa_v1"), "roll": F.when(k % 11 == 0, "roll-CW ").otherwise("roll-CW"), "tilt": F.lit("tilt-up")}
    s = labels.CAMERA_OUTPUT
    field = lambda name, domain: own.get(name, F.lit(domain[0])).alias(name)
    parts = [field(n, dom) for n, dom in s.single.items()] + [own[n].alias(n) for n in s.fixed]
    parts += [F.struct(*[field(n, dom) for n, dom in fields.items()]).alias(g) for g, fields in s.groups.items()]
    rows = t(spark, d, "part").select("p_partkey", F.to_json(F.struct(*parts, effects.alias("effects"))).alias("json"))
    rows = rows.select("p_partkey", s.checked(F.col("json")).alias("c")).select("p_partkey", "c.error", F.col("c.labels").alias("l"))
    return rows.select("p_partkey", "error", "l.motion_type", F.col("l.rotation.tilt").alias("tilt"), F.array_join("l.effects", ",").alias("effects"), "l.label_version")


@query("""WITH i AS (SELECT 'metadata-' || (o_orderkey % 16) AS shard, (o_orderkey % 4 + 1) || 'x' || (o_custkey % 3 + 1) || 'x60' AS latent, CASE WHEN o_custkey % 5 > 0 THEN o_orderpriority END AS resolution, o_totalprice > 100000 AS ok FROM orders)
SELECT 'shard' AS kind, shard AS value, count(*) AS rows, count(*) FILTER (ok) AS valid_rows, count(*) FILTER (NOT ok) AS invalid_rows FROM i GROUP BY 2
UNION ALL SELECT 'latent', latent, count(*), count(*) FILTER (ok), count(*) FILTER (NOT ok) FROM i GROUP BY 2 UNION ALL SELECT 'source', resolution, count(*), count(*) FILTER (ok), count(*) FILTER (NOT ok) FROM i GROUP BY 2""")
def dataset_parts(spark, d):
    k = F.col("o_orderkey")
    latent = F.concat((k % 4 + 1).cast("string"), F.lit("x"), (F.col("o_custkey") % 3 + 1).cast("string"), F.lit("x60"))
    items = t(spark, d, "orders").select(F.concat(F.lit("metadata-"), (k % 16).cast("string")).alias("shard"), latent.alias("latent"), F.when(F.col("o_custkey") % 5 > 0, F.col("o_orderpriority")).alias("r"), "o_totalprice")
    return metadata.dataset_parts(items, F.col("o_totalprice") > 100000, shard="shard", latent="latent", source="r")


@query(f"""WITH v AS ({_WIDE}), p AS (SELECT x.id AS a, y.id AS b, (bit_count(xor(x.code[1], y.code[1])) + bit_count(xor(x.code[2], y.code[2])) + bit_count(xor(x.code[3], y.code[3])) + bit_count(xor(x.code[4], y.code[4])))::INT AS distance FROM v x JOIN v y ON x.id <> y.id)
SELECT a, b, distance FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY distance, b) rn FROM p WHERE distance <= 31) WHERE rn <= 4""")
def hamming_matches_with_self(spark, d):
    return similarity.hamming_matches(_wide_codes(spark, d), 31, 5, self_counts=True).withColumn("distance", F.col("distance").cast("int"))


@query(f"{_COMP}, z AS (SELECT component, count(*) AS size FROM l GROUP BY 1) SELECT node AS id, size AS group_size, (node = component)::BIGINT AS is_best, component::VARCHAR AS best_id FROM l JOIN z USING (component)")
def two_phase_dedup(spark, d):
    rows = t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.lit(1).alias("ok"), F.lit("").alias("error"), F.col("embedding").alias("vector"), F.lit(1).alias("n"))
    method = dedup.VectorDeduplicator("cosmos", least=0.4, k=10_000)
    out = dedup.dedup_rows(rows, [method], f"{tables.shared_folder(spark)}/dedup-{uuid.uuid4().hex}", parts=2).where("cosmos_group_id <> ''")
    return out.select("id", F.col("cosmos_group_size").alias("group_size"), F.col("cosmos_is_best_clip_in_group").alias("is_best"), F.col("cosmos_best_clip_id_in_group").alias("best_id"))


# --- sources and sinks: tables written into the shared folder and read again --------------------------------

def _folder(spark):
    return f"{tables.shared_folder(spark)}/unit-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_totalprice::DOUBLE AS price FROM orders WHERE o_totalprice > 150000")
def unit_round_trip(spark, d):
    rows, path = t(spark, d, "orders"), _folder(spark)
    shards.write_unit(rows, path, "order", rows_per_shard=2000)
    return shards.read_unit(spark, path, "order", rows.schema, columns=["o_orderkey", "o_totalprice"], where=F.col("o_totalprice") > 150000).select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"))


@query("SELECT o_orderkey, n::BIGINT AS n FROM (SELECT o_orderkey, 1 AS n FROM orders UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderkey % 3 = 0)")
def unit_appended(spark, d):
    rows, path = t(spark, d, "orders").select("o_orderkey", F.lit(1).cast("long").alias("n")), _folder(spark)
    shards.write_unit(rows, path, "order")
    shards.write_unit(rows.where("o_orderkey % 3 = 0").withColumn("n", F.lit(2).cast("long")), path, "order", reset=False)
    return shards.read_unit(spark, path, "order", rows.schema)


@query("SELECT count(*) AS rows, min(o_orderkey) AS o_orderkey_min, max(o_orderkey) AS o_orderkey_max, min(o_totalprice)::DOUBLE AS o_totalprice_min, max(o_totalprice)::DOUBLE AS o_totalprice_max FROM orders")
def footer_stats(spark, d):
    rows, path = t(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice")), _folder(spark)
    shards.write_unit(rows, path, "order")
    return shards.footer_stats(spark, path, "order", rows.schema, ["o_orderkey", "o_totalprice"])


@query("SELECT 'pass' AS part, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'reject', count(*) FROM orders WHERE o_orderstatus <> 'F'")
def pass_reject_parts(spark, d):
    rows, path = t(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("long").alias("ok")), _folder(spark)
    shards.write_pass_reject(rows, path, "order", "ok")
    part = lambda name: shards.read_unit(spark, f"{path}/{name}", "order", rows.schema).groupBy(F.lit(name).alias("part")).agg(F.count("*").alias("n"))
    return part("pass").union(part("reject"))


@query("SELECT 'clips/' || o_orderkey || '.mp4' AS path, (o_custkey % 7)::VARCHAR AS label, (o_custkey % 7)::DOUBLE AS number FROM orders")
def manifest_round_trip(spark, d):
    lines, path = t(spark, d, "orders").select(F.concat(F.lit("clips/"), F.col("o_orderkey").cast("string"), F.lit(".mp4")).alias("p"), (F.col("o_custkey") % 7).cast("string").alias("l")), _folder(spark)
    shards.write_manifest(sampling.manifest_lines(lines, "p", "l"), path)
    return shards.read_manifest(spark, path).withColumn("number", shards.label_number(F.col("label")))


@query("""SELECT id, source, count(*) OVER (PARTITION BY shard) AS shard_rows FROM (SELECT doc_id AS id, source, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard FROM documents)""")
def metadata_round_trip(spark, d):
    path = _folder(spark)
    metadata.write_metadata(t(spark, d, "documents").select(F.col("doc_id").alias("id"), "source"), path, "id", 100)
    items = metadata.read_metadata(spark, path, "id long, source string", required=["id"], shard_col="shard")
    sizes = items.groupBy("shard").agg(F.count("*").alias("shard_rows"))
    return items.join(sizes, "shard").select("id", "source", "shard_rows")


@query("SELECT vec_id, len(embedding)::INT AS value_count, round(embedding[1]::DOUBLE, 5) AS first FROM embeddings")
def feature_store(spark, d):
    path = _folder(spark)
    features.save_features(t(spark, d, "embeddings").select("vec_id", "embedding"), path, "embedding", "vectors", "v1")
    return features.load_features(spark, path).select("vec_id", "value_count", F.round(F.col("embedding")[0].cast("double"), 5).alias("first"))


@query("SELECT DISTINCT o_custkey::VARCHAR AS id FROM orders WHERE o_orderkey % 2 = 0")
def id_lists(spark, d):
    path = _folder(spark)
    outputs.write_id_lists(t(spark, d, "orders").where("o_orderkey % 2 = 0"), path, "o_orderkey", "o_orderkey", "o_custkey")
    return shards.read_ids(spark, [f"{path}/video_ids.txt"], strict=True)


# --- passes merged, texts, coercions ------------------------------------------------------------------------

@query("""SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'optical,motion' ELSE 'optical,text,motion' END AS filters, least(CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE 1 END, CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 1 END)::BIGINT AS ok,
 concat_ws('; ', CASE WHEN o_custkey % 5 = 0 THEN 'first' END, CASE WHEN o_custkey % 2 = 0 THEN 'second' END) AS error, 2::BIGINT AS run FROM orders""")
def merged_passes(spark, d):
    k, names = F.col("o_custkey"), lambda *n: F.array(*map(F.lit, n))
    one = t(spark, d, "orders").select("o_orderkey", F.when(k % 3 == 0, names("optical")).otherwise(names("optical", "text")).alias("filters"), (k % 5 > 0).cast("long").alias("ok"), F.when(k % 5 == 0, "first").otherwise("").alias("error"), F.lit(1).cast("long").alias("run"))
    two = t(spark, d, "orders").select("o_orderkey", names("motion", "optical").alias("filters"), (k % 2 > 0).cast("long").alias("ok"), F.when(k % 2 == 0, "second").otherwise("").alias("error"), F.lit(2).cast("long").alias("run"))
    return joins.merge_pass(one, two, "o_orderkey", "filters", "ok", "error").select("o_orderkey", F.array_join("filters", ",").alias("filters"), "ok", "error", "run")


@query("""SELECT p_partkey, 'Describe.' || chr(10) || chr(10) || 'Frames:' || chr(10) || '- frame_0000: 0.000s' || chr(10) || '- frame_0001: ' || CASE WHEN p_partkey % 4 = 0 THEN 'unknown' ELSE printf('%.3fs', p_size / 8::DOUBLE) END
 || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE chr(10) || chr(10) || 'Audio transcript:' || chr(10) || p_name END || chr(10) || chr(10) || 'Camera labels:' || chr(10) || 'size: ' || p_size || chr(10) || 'brand: ' || p_brand AS prompt FROM part""")
def caption_prompts(spark, d):
    seconds = F.array(F.lit(0.0), F.when(F.col("p_partkey") % 4 == 0, -1.0).otherwise(F.col("p_size") / 8))
    labels_ = prompts.label_lines(F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand")), ["size", "brand"])
    heard = F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(F.col("p_name"))
    return t(spark, d, "part").select("p_partkey", prompts.caption_prompt("Describe.", seconds, heard, labels_, F.lit("")).alias("prompt"))


@query("""SELECT event_id, try_cast(trim(replace(props, '"', '')) AS DOUBLE) IS NULL AS odd, event_type IN ('view', 'click') AS seen, CASE WHEN user_id % 9 > 0 THEN event_type END AS kind, CASE user_id % 4 WHEN 0 THEN ['a', 'b'] WHEN 1 THEN [event_type] ELSE [] END::VARCHAR AS names FROM events""")
def coerced_settings(spark, d):
    u, e = F.col("user_id"), F.col("event_type")
    flag = F.when(e.isin("view", "click"), F.when(u % 2 == 0, " Yes").otherwise("1")).otherwise(F.when(u % 2 == 0, "off").otherwise(""))
    names = F.when(u % 4 == 0, F.lit('["a", "b"]')).when(u % 4 == 1, e).when(u % 4 == 2, F.lit(" ")).otherwise(F.lit("[]"))
    listed = F.concat(F.lit("["), F.array_join(prompts.coerce_names(names), ", "), F.lit("]"))
    return t(spark, d, "events").select("event_id", prompts.coerce_number(F.trim(F.regexp_replace("props", '"', ""))).isNull().alias("odd"), prompts.coerce_bool(flag).alias("seen"), prompts.coerce_optional(F.when(u % 9 > 0, F.concat(F.lit(" "), e)).otherwise(F.lit(" NULL "))).alias("kind"), listed.alias("names"))


@query("""SELECT p_partkey, list_transform(generate_series(0, p_size % 6), lambda i: CASE WHEN i < p_size % 6 THEN format('{:.6f}', least(i / 4::DOUBLE, 1.0::DOUBLE))::DOUBLE ELSE -1 END)::DOUBLE[]::VARCHAR AS seconds,
 regexp_replace(p_name, 'a', 'b', 'g') = p_name AS clean, CASE WHEN p_size % 2 = 0 THEN 'x/' || p_partkey ELSE '/data/x/' || p_partkey END AS path FROM part""")
def frame_times(spark, d):
    n = F.col("p_size") % 6
    seconds = geometry_times(n)
    path = X.strip_prefix_path(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("/root/x/"), F.col("p_partkey").cast("string"))).otherwise(F.concat(F.lit("/data/x/"), F.col("p_partkey").cast("string"))), "/root")
    as_text = F.concat(F.lit("["), F.array_join(F.transform(seconds, lambda s: s.cast("string")), ", "), F.lit("]"))
    return t(spark, d, "part").select("p_partkey", as_text.alias("seconds"), (~F.col("p_name").contains("a")).alias("clean"), path.alias("path"))


def geometry_times(n):
    """Seconds of n frames at four a second, no later than one, filled up by one that is unknown."""
    times = G.uniform_timestamps(n, F.lit(4.0), F.lit(1.0))
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.coalesce(F.get(times, i), F.lit(-1.0)))
