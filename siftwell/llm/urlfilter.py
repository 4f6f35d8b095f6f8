"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

Native throughout: parsing, hashing, training and judging are Spark SQL expressions. Training folds full
gradient steps over the few labelled rows with higher-order functions in one row, so it needs no loop of
jobs; what reaches the driver is one weight array of `dims` numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (kind, rule): a rule is host and path joined; it covers the host and its subdomains and paths that start so.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

#: The labelled table: URLs to block, then URLs to allow, written down from what such sites are called in general; no site of it is in a judged table.
#: Both use the common domains, so that these decide nothing.
BLOCKED = """
http://casino-bonus.org/register https://best-online-casino.net/slots/ http://vegas-casino-club.info/jackpot https://royal-casino.net/deposit http://casino-slots-spin.info/spin
https://poker-room.net/tables http://texas-poker-win.info/bonus https://poker-chips-free.net/join http://bet-and-win.info/odds https://sports-bets.net/live-odds
http://freebets-today.info/signup https://horse-bets-win.net/tips http://lottery-winner.info/claim https://slots-jackpot.org/spin http://win-big-jackpot.info/play
http://cheap-meds-online.org/checkout https://pills-without-prescription.info/cart http://discount-pills.org/shop https://viagra-pills-store.info/order http://pharma-cheap-pills.org/buy
https://diet-pills-fast.info/offer http://weightloss-miracle.org/offer https://cheap-viagra.info/order http://miracle-pills.org/buy https://cheap-pharma-shop.info/cart
https://payday-loans-now.org/apply http://instant-cash-loans.info/apply https://cheap-loans-fast.org/approved http://earn-money-fast.info/join https://fast-cash-money.org/secret
http://free-money-win.info/claim https://crypto-money-double.org/invest http://easy-loans-cash.info/apply https://win-free-cash.org/prize http://money-from-home-fast.info/start
http://adult-dating-tonight.org/singles https://adult-webcams.info/rooms http://hot-xxx-videos.org/watch https://free-adult-videos.info/stream http://adult-xxx-cams.org/enter
https://xxx-live-cams.info/join http://adult-chat-rooms.org/enter https://free-xxx-movies.info/watch http://adult-singles.org/join https://webcams-adult.com/live
http://adserver.click-network.org/banner https://ads.popup-media.com/serve http://track.ad-clicks.org/pixel https://click-tracker.com/redirect http://ads-tracking-hub.org/collect
https://banner-ads-network.com/show http://popup-ads.org/open https://ads-clicks-track.com/go http://tracker-pixel-ads.org/pixel https://adserver-track.com/click
http://spam-mailer.org/bulk https://bulk-spam-lists.com/download http://link-farm-network.org/links https://seo-link-farm.com/backlinks http://spam-links-farm.org/links
https://mass-spam-tools.com/buy http://comment-spam-bot.org/download https://cheap-backlinks-farm.com/packages http://spam-sender.org/bulk https://link-spam-farm.net/seo
http://replica-watches-shop.org/sale https://cheap-replica-bags.net/sale http://replica-watches-cheap.org/order https://free-ringtones-win.net/get http://claim-free-gift.org/reward
https://free-prize-winner.net/survey http://you-win-free-gift.org/claim https://cheap-replica-shoes.net/buy http://free-gift-cards-win.org/claim https://free-download-crack.net/get
"""
ALLOWED = """
https://library.northfield.edu/catalogue/search http://gardens-weekly.co.uk/roses/pruning https://docs.opentools.io/install/linux http://museum-of-glass.org/exhibitions https://weather.coast.gov/forecast
http://history-of-bridges.org/arches/stone https://recipes.grandmother.net/soups/lentil http://school-district.k12.us/calendar https://university.hilltown.edu/admissions/faculty http://townhall.rivermouth.gov/minutes
https://forum.woodworkers.net/joints/dovetail http://wiki.linguistics.org/phonology/vowels https://blog.mathematician.me/primes http://news.valleytimes.com/politics/council https://www.orchestra-hall.org/season/tickets
http://theatre.oldtown.org/programme https://health.ministry.gov/vaccines/children http://stadtbibliothek.de/ausleihe https://www.verein-der-imker.de/honig http://nachrichten-heute.de/wirtschaft
https://rathaus-lindenau.de/termine http://wanderwege-im-harz.de/karte https://cuisine-de-saison.fr/recettes/tarte http://mairie-de-montclair.fr/urbanisme https://journal-du-matin.fr/culture
http://lycee-descartes.fr/inscriptions https://bibliotheque-municipale.fr/horaires http://ayuntamiento-de-ronda.es/tramites https://cocina-de-la-abuela.es/postres http://noticias-del-sur.es/deportes
https://universidad-abierta.es/cursos http://teatro-principal.es/cartelera https://astronomy.stargazers.org/planets/saturn http://birds.naturewatch.org/species/heron https://trains.heritage-railway.org/timetable
http://chess.clubhouse.org/openings/sicilian https://physics.lectures.edu/mechanics/notes http://chemistry.students.edu/lab/titration https://maps.hikers.net/trails/ridge http://photos.mountaineers.org/alps
https://radio.community.fm/schedule http://podcast.storytellers.net/episodes https://hospital.stjames.org/departments/cardiology http://dentist-on-mainstreet.com/hours https://bakery-corner.com/bread/rye
http://bookshop-by-the-river.com/poetry https://florist-and-daughters.com/bouquets http://bicycle-repair.org/brakes https://plumbing-manual.net/pipes/copper http://python-tutorials.io/iterators
https://database-notes.io/indexes/trees http://compilers.lectures.edu/parsing https://statistics.handbook.org/regression http://economics.institute.org/papers/trade https://parliament.nation.gov/debates
http://court-records.state.gov/rulings https://charity-water-wells.org/projects http://church-of-saint-anne.org/services https://football-league-amateur.org/fixtures http://swimming-association.org/results
https://tide-tables.harbour.org/monthly http://seeds-exchange.gardeners.net/tomatoes https://knitting-patterns.net/scarves http://violin-teachers.org/lessons https://watercolour-painting.net/landscapes
http://genealogy-society.org/archives https://antique-clocks.org/restoration http://beekeepers.union.org/hives https://lighthouse-keepers.org/stories http://volcano-observatory.gov/bulletins
https://ferry-crossings.net/timetable http://hostel-in-the-hills.com/rooms https://train-station-cafe.com/menu http://village-festival.org/programme https://kindergarten-sunflower.de/gruppen
http://the-morning-reader.com/essays https://threshold-theory.org/lectures http://nation-and-station.org/essays https://rhetoric-and-thought.org/authors http://northern-shepherds.org/wool
"""


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label (1 block, 0 allow)."""
    rows = lambda urls, label: spark.range(1).select(F.explode(F.split(F.lit(urls.strip()), r"\s+")).alias("url"), F.lit(label).alias("label"))
    return rows(BLOCKED, 1.0).union(rows(ALLOWED, 0.0))


def url_host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def ngram_buckets(host: Column, path: Column, dims: int, n: int = 4) -> Column:
    """Distinct hashed n-grams of ^host and of the path's letters (numbers say nothing about a site)."""

    def grams(kind: str, s: Column) -> Column:
        padded = F.concat(F.lit(f"{kind}^"), s, F.lit("$"))
        count = F.greatest(F.char_length(padded) - F.lit(n - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), count), lambda i: F.pmod(F.xxhash64(padded.substr(i, F.lit(n))), F.lit(dims)).cast("int"))

    return F.array_distinct(F.concat(grams("h", host), grams("p", F.regexp_replace(path, r"[0-9]+", "0"))))


def train_url_weights(labelled: DataFrame, dims: int = 4096, steps: int = 150, rate: float = 0.5, decay: float = 0.002, max_rows: int = 1000) -> list[float]:
    """Weights of the hashed n-grams, the bias last. `labelled` (url, label) is small: over max_rows rows are refused.

    Rows of null label are left out; an empty table gives zero weights.
    """
    rows = labelled.where("label is not null").limit(max_rows + 1)
    buckets = ngram_buckets(url_host(F.col("url")), url_path(F.col("url")), dims)
    one = rows.select("label", F.array_append(buckets, F.lit(dims)).alias("x")).agg(F.array_sort(F.collect_list(F.struct("x", "label"))).alias("rows"))
    # h: for every bucket the numbers of the rows that hold it
    holders = f"transform(sequence(0, {dims}), j -> filter(sequence(0, size(rows) - 1), i -> array_contains(rows[i].x, j)))"
    errors = "transform(rows, r -> 1 / (1 + exp(-aggregate(r.x, 0D, (s, j) -> s + a.w[j]))) - r.label)"
    weights = f"transform(a.w, (v, j) -> v * {1 - rate * decay}D - {rate}D * aggregate(a.h[j], 0D, (s, i) -> s + a.e[i]) / size(rows))"
    # odd turns take the errors from the weights, even turns the weights from the errors
    fit = (
        f"aggregate(sequence(1, {2 * steps}), named_struct('w', array_repeat(0D, {dims + 1}), 'e', array_repeat(0D, size(rows)), 'h', {holders}), "
        f"(a, t) -> IF(t % 2 = 1, named_struct('w', a.w, 'e', {errors}, 'h', a.h), named_struct('w', {weights}, 'e', a.e, 'h', a.h)), a -> a.w)"
    )
    if one.select(F.size("rows")).first()[0] > max_rows:
        raise ValueError(f"more than {max_rows} labelled rows")
    found = one.where("size(rows) > 0").select(F.expr(fit).alias("w")).first()
    return list(found.w) if found else [0.0] * (dims + 1)


def _within(host: Column, path: Column, rule: str) -> Column:
    rule_host, slash, rule_path = rule.partition("/")
    fits = (host == rule_host) | host.endswith("." + rule_host)
    return fits & path.startswith(slash + rule_path)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its kind) of the longest rule that fits, null if none does."""
    rule, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        fits = _within(host, path, r)
        rule, kind = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(k)).otherwise(kind)
    return rule, kind


def judge_urls(df: DataFrame, weights: list[float], rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id_col, url_col, host, path, rule, p_block, verdict for every row, without a shuffle.

    A null url or one without :// has an empty host and path: no rule fits and the model judges the
    empty strings. Repeated rows and null ids are kept; other columns are left out.
    """
    dims = len(weights) - 1
    w = F.array(*map(F.lit, weights))
    parsed = df.select(F.col(id_col), F.col(url_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rule, kind = longest_rule(F.col("host"), F.col("path"), rules)
    score = F.aggregate(ngram_buckets(F.col("host"), F.col("path"), dims), F.lit(weights[dims]), lambda s, j: s + F.get(w, j))
    return parsed.withColumns({"rule": rule, "p_block": 1 / (1 + F.exp(-score)), "kind": kind}).select(
        id_col, url_col, "host", "path", "rule", "p_block",
        F.coalesce("kind", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"),
    )
