"""Joins, aggregates, profiles, recommendation."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainfold.functions.numeric import bin_by, guarded_ratio
from grainfold.functions.text import genre_score
from grainfold.operators import clean, evaluate, lookup, profile, recommend as rec
from grainfold.plans.registry import query, r, r_half
from grainfold.sources.readers import read_table

_SHIPMENTS = """SELECT l.l_suppkey, month(l.l_shipdate) AS ship_month, p.p_type, o.o_orderpriority,
  CASE WHEN l.l_quantity < 5 THEN 0 WHEN l.l_quantity < 20 THEN 1 ELSE 2 END AS qty_bin,
  CASE WHEN p.p_size < 10 THEN 0 WHEN p.p_size < 30 THEN 1 ELSE 2 END AS size_bin,
  CASE WHEN l.l_quantity = 0 THEN 0 ELSE l.l_extendedprice * (1 - l.l_discount) / l.l_quantity END AS rev_per_unit
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_extendedprice <> 0"""
PEER = ["ship_month", "p_type", "o_orderpriority", "qty_bin", "size_bin"]


def shipments(spark, sf):
    """Line items with what makes shipments comparable, and their revenue per unit."""
    lines = read_table(spark, sf, "lineitem").where("l_extendedprice <> 0")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    parts = read_table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey)
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return joined.select(
        "l_suppkey", F.month("l_shipdate").alias("ship_month"), "p_type", "o_orderpriority",
        bin_by(F.col("l_quantity"), [5, 20]).alias("qty_bin"), bin_by(F.col("p_size"), [10, 30]).alias("size_bin"),
        guarded_ratio(revenue, F.col("l_quantity")).alias("rev_per_unit"),
    )


@query(f"""WITH f AS ({_SHIPMENTS}), d AS (SELECT *, rev_per_unit - avg(rev_per_unit) OVER (
  PARTITION BY ship_month, p_type, o_orderpriority, qty_bin, size_bin) AS deviation FROM f)
SELECT l_suppkey, p_type, qty_bin, round(avg(deviation) + 1e-7, 4) AS willingness, count(*) AS n
FROM d GROUP BY l_suppkey, p_type, qty_bin""")
def agent_willingness(spark, sf):
    out = lookup.mean_peer_deviation(
        shipments(spark, sf), "rev_per_unit", PEER, ["l_suppkey", "p_type", "qty_bin"], "willingness"
    )
    return out.withColumn("willingness", r_half("willingness"))


@query(f"""WITH f AS ({_SHIPMENTS}) SELECT ship_month, p_type, o_orderpriority, qty_bin, size_bin,
  round(avg(rev_per_unit) + 1e-7, 4) AS mean_rev, count(*) AS n FROM f GROUP BY ALL""")
def peer_group_mean(spark, sf):
    return shipments(spark, sf).dropna(subset=PEER).groupBy(*PEER).agg(
        r_half(F.avg("rev_per_unit")).alias("mean_rev"), F.count(F.lit(1)).alias("n")
    )


@query("""SELECT o_orderkey, round(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_custkey) + 1e-7, 4) AS deviation
FROM orders WHERE o_custkey % 10 <> 0 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_custkey % 10 = 0""")
def peer_deviation(spark, sf):
    # customers ending in 0 stand for unknown peers
    t = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("peer")
    )
    return lookup.peer_deviation(t, "o_totalprice", ["peer"]).select("o_orderkey", r_half("deviation").alias("deviation"))


# ---- joins

@query("""SELECT o.o_orderkey, c.c_name, n.n_name, g.r_name, o.o_totalprice FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region g ON n.n_regionkey = g.r_regionkey""")
def join_chain(spark, sf):
    o, c, n, g = (read_table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    return (
        o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
        .join(g, n.n_regionkey == g.r_regionkey)
        .select("o_orderkey", "c_name", "n_name", "r_name", "o_totalprice")
    )


@query("""SELECT c_custkey, rate, round(c_acctbal / rate + 1e-7, 4) AS converted FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT n_name AS currency, 1.0 + n_nationkey / 10.0 AS rate FROM nation WHERE n_nationkey < 20) ON n_name = currency""")
def rate_lookup(spark, sf):
    nation = read_table(spark, sf, "nation")
    names = [f"NATION_{i}" for i in range(20)]
    # one row with a column per currency, as rate files come
    wide = nation.where("n_nationkey < 20").groupBy().pivot("n_name", names).agg(
        F.first(1.0 + F.col("n_nationkey") / 10.0)
    )
    rates = clean.normalise_names(wide.toDF(*[f" {c} " for c in wide.columns]))
    rows = read_table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumnRenamed("n_name", "currency")
    return lookup.rate_lookup(rows, rates, "currency").select(
        "c_custkey", "rate", r_half(F.col("c_acctbal") / F.col("rate")).alias("converted")
    )


@query("""SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100)""")
def semi_join(spark, sf):
    t = read_table(spark, sf, "events")
    buyers = t.where("event_type = 'purchase' and value > 100").select("user_id")
    return lookup.keep_matching(t.select("event_id", "user_id"), buyers, "user_id")


@query("""SELECT c_custkey FROM customer WHERE c_custkey <> 7 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""")
def anti_join(spark, sf):
    dear = read_table(spark, sf, "orders").where("o_totalprice > 450000")
    orders = dear.select(F.col("o_custkey").alias("c_custkey"))
    return lookup.drop_matching(read_table(spark, sf, "customer").select("c_custkey").where("c_custkey <> 7"), orders, "c_custkey")


@query("""SELECT l_orderkey, l_partkey, l_linenumber, p_name AS part_p_name, p_size AS part_p_size FROM lineitem
LEFT JOIN (SELECT * FROM part WHERE p_size < 25) ON l_partkey = p_partkey""")
def dim_lookup(spark, sf):
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    parts = read_table(spark, sf, "part").where("p_size < 25")
    return lookup.dim_lookup(lines, parts, "l_partkey", "p_partkey", ["p_name", "p_size"], prefix="part_")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN lo <> hi THEN first_supp ELSE l_suppkey END AS code FROM lineitem
JOIN (SELECT l_partkey, min(l_suppkey) AS lo, max(l_suppkey) AS hi, min_by(l_suppkey, l_orderkey * 1000000 + l_suppkey) AS first_supp
  FROM lineitem GROUP BY l_partkey) USING (l_partkey)""")
def canonical_code(spark, sf):
    t = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("code"),
        F.struct("l_orderkey", "l_suppkey").alias("seen"),
    )
    return lookup.use_canonical_code(t, "l_partkey", "code", "seen").drop("seen")


@query("""SELECT count_if(a IS NOT NULL AND b IS NOT NULL) AS paired, count_if(b IS NULL) AS only_left, count_if(a IS NULL) AS only_right
FROM (SELECT doc_id AS a FROM documents) FULL JOIN (SELECT doc_id * 2 AS b FROM labels) ON a = b""")
def pair_check(spark, sf):
    labels = read_table(spark, sf, "labels").select((F.col("doc_id") * 2).alias("doc_id"))
    return lookup.pair_check(read_table(spark, sf, "documents"), labels, "doc_id")


# ---- aggregates

@query("""SELECT l_returnflag, sum(l_extendedprice)::DECIMAL(30, 2)::DOUBLE AS revenue, round(sum(1000 * l_quantity), 2) AS cost,
  round(sum(l_extendedprice) - sum(1000 * l_quantity), 2) AS profit FROM lineitem GROUP BY l_returnflag""")
def segment_profit(spark, sf):
    t = read_table(spark, sf, "lineitem").withColumn("cost", 1000 * F.col("l_quantity"))
    out = profile.segment_profit(t, "l_returnflag", "l_extendedprice", "cost")
    return out.select("l_returnflag", *[r(c, 2).alias(c) for c in ("revenue", "cost", "profit")])


_FACTORS = ["l_returnflag", "l_linestatus", "ship_year", "ship_month"]


@query(" UNION ALL ".join(f"""SELECT '{f}' AS factor, {f}::VARCHAR AS level, round(avg(l_quantity), 4) AS avg_l_quantity,
  round(avg(l_extendedprice), 4) AS avg_l_extendedprice, count(*) AS n
  FROM (SELECT *, year(l_shipdate) AS ship_year, month(l_shipdate) AS ship_month FROM lineitem) GROUP BY {f}""" for f in _FACTORS))
def profile_by_factor(spark, sf):
    t = read_table(spark, sf, "lineitem").withColumns(
        {"ship_year": F.year("l_shipdate"), "ship_month": F.month("l_shipdate")}
    )
    out = profile.profile_by_factor(t, _FACTORS, ["l_quantity", "l_extendedprice"])
    return out.withColumns({c: r(c) for c in ("avg_l_quantity", "avg_l_extendedprice")})


@query("""SELECT p_type, round(avg(l_extendedprice), 4) AS mean_price, round(median(l_extendedprice), 4) AS median_price
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def class_price_stats(spark, sf):
    parts = read_table(spark, sf, "part").select("p_partkey", "p_type")
    t = read_table(spark, sf, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select("p_type", "l_extendedprice")
    mid = profile.quantiles(t, ["p_type"], "l_extendedprice", [0.5])
    mean = t.groupBy("p_type").agg(r(F.avg("l_extendedprice")).alias("mean_price"))
    return mean.join(mid, "p_type").select("p_type", "mean_price", r("q50").alias("median_price"))


@query("""SELECT round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS low,
  max(o_totalprice) AS high, count(*) AS n FROM orders""")
def summary(spark, sf):
    return read_table(spark, sf, "orders").agg(
        r(F.sum("o_totalprice"), 2).alias("total"), r(F.avg("o_totalprice")).alias("mean"),
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.count(F.lit(1)).alias("n"),
    )


@query("""SELECT l_partkey, round(avg(l_quantity / 10), 6) AS rating_score FROM lineitem GROUP BY l_partkey""")
def avg_rating(spark, sf):
    t = read_table(spark, sf, "lineitem").withColumn("rating", F.col("l_quantity") / 10)
    return rec.avg_rating(t, "l_partkey", "rating").withColumn("rating_score", r("rating_score", 6))


@query("""SELECT 'doc_id' AS "column", count(doc_id) AS known FROM documents UNION ALL SELECT 'lang', count(lang) FROM documents
UNION ALL SELECT 'quality', count(quality) FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'toxic', count(toxic) FROM documents LEFT JOIN labels USING (doc_id)""")
def completeness(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang")
    return profile.completeness(docs.join(read_table(spark, sf, "labels"), "doc_id", "left"))


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(median({c}), 4) AS q50,
  round(quantile_cont({c}, 0.75), 4) AS q75 FROM lineitem""" for c in _DESCRIBED))
def describe(spark, sf):
    out = profile.describe(read_table(spark, sf, "lineitem"), _DESCRIBED)
    rounded = ["mean", "std", "q25", "q50", "q75"]
    return out.select("column", "count", "min", "max", *[r(c).alias(c) for c in rounded])


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM orders"""
       for c in ("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")))
def distinct_profile(spark, sf):
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]
    return profile.distinct_profile(read_table(spark, sf, "orders"), columns)


@query("SELECT p_name, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 10")
def value_counts(spark, sf):
    return profile.value_counts(read_table(spark, sf, "part"), "p_name", 10)


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(f"SELECT '{b}' AS a, '{a}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
       for i, a in enumerate(_CORR) for b in _CORR[i + 1:]))
def corr_matrix(spark, sf):
    return profile.corr_matrix(read_table(spark, sf, "lineitem"), _CORR).withColumn("r", r("r", 6))


@query("""SELECT c_custkey, round((c_acctbal - lo) / (hi - lo), 6) AS scaled FROM customer,
  (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)""")
def minmax_norm(spark, sf):
    out = profile.minmax_norm(read_table(spark, sf, "customer"), "c_acctbal", "scaled")
    return out.select("c_custkey", r("scaled", 6).alias("scaled"))


@query("""SELECT event_id, round(value / (SELECT max(value) FROM events WHERE event_id % 2 = 0), 6) AS scaled,
  round(value - (SELECT avg(value) FROM events), 4) AS centred FROM events""")
def max_norm(spark, sf):
    t = read_table(spark, sf, "events").select("event_id", "value")
    t = profile.centre(t, "value", "centred")
    out = profile.max_norm(t, "value", "scaled", by=read_table(spark, sf, "events").where("event_id % 2 = 0"))
    return out.select("event_id", r("scaled", 6).alias("scaled"), r("centred").alias("centred"))


@query("""SELECT label, count(DISTINCT vec_id) AS n_rows, count(*) AS n_values, round(avg(x::DOUBLE), 6) AS mean,
  round(stddev_pop(x::DOUBLE), 6) AS std FROM (SELECT vec_id, label, unnest(embedding) AS x FROM embeddings) GROUP BY label""")
def array_stats(spark, sf):
    out = profile.array_stats(read_table(spark, sf, "embeddings"), "embedding", ["label"])
    return out.withColumns({"mean": r("mean", 6), "std": r("std", 6)})


@query("""SELECT o_orderstatus, CASE WHEN o_totalprice < 0 THEN 0 WHEN o_totalprice >= 400000 THEN 21
  ELSE floor(o_totalprice / 20000)::BIGINT + 1 END AS bin, count(*) AS n FROM orders GROUP BY 1, 2""")
def histogram2(spark, sf):
    return profile.histogram(read_table(spark, sf, "orders"), "o_totalprice", 0, 400000, 20, ["o_orderstatus"])


# ---- tags and recommendation: parts as items, customers as users, quantity / 10 as rating

_TAGS = """(SELECT l_partkey AS item, CASE WHEN l_linenumber % 2 = 0 THEN lower(l_returnflag || l_linestatus || l_linenumber)
  ELSE l_returnflag || l_linestatus || l_linenumber END AS tag FROM lineitem)"""
_ANCHOR = 7


def _tags(spark, sf):
    tag = F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    return read_table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("item"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lower(tag)).otherwise(tag).alias("tag"),
    )


def _ratings(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    lines = read_table(spark, sf, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "user", F.col("l_partkey").alias("item"), (F.col("l_quantity") / 10).alias("rating")
    )


@query(f"""SELECT item, tag, round(n / sum(n) OVER (PARTITION BY item), 6) AS freq
FROM (SELECT item, lower(tag) AS tag, count(*) AS n FROM {_TAGS} GROUP BY 1, 2)""")
def tag_profile(spark, sf):
    return rec.tag_profile(_tags(spark, sf), "item", "tag").withColumn("freq", r("freq", 6))


_TAG_SCORE = f"""WITH c AS (SELECT item, lower(tag) AS tag, count(*) AS n FROM {_TAGS} GROUP BY 1, 2),
  a AS (SELECT tag, n AS a FROM c WHERE item = {_ANCHOR}),
  s AS (SELECT item, sum(n * coalesce(a, 0)) / sum(n) / (SELECT sum(a) FROM a) AS tag_score
    FROM c LEFT JOIN a USING (tag) WHERE item <> {_ANCHOR} GROUP BY item)"""


@query(f"{_TAG_SCORE} SELECT item, round(tag_score, 6) AS tag_score FROM s")
def tag_similarity(spark, sf):
    return rec.tag_similarity(_tags(spark, sf), "item", "tag", _ANCHOR).withColumn("tag_score", r("tag_score", 6))


@query(f"""{_TAG_SCORE}, u AS (SELECT o_custkey AS user, l_partkey AS item, l_quantity / 10 AS rating FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  fans AS (SELECT DISTINCT user FROM u WHERE item = {_ANCHOR} AND rating >= 2.0),
  liked AS (SELECT DISTINCT item FROM u WHERE rating >= 2.0 AND user IN (SELECT user FROM fans)),
  best AS (SELECT item, avg(rating) AS rating_score FROM u GROUP BY item HAVING avg(rating) > 2.4)
SELECT item, p_name || ' (' || (1950 + p_size) || ')' AS title, round(CASE WHEN contains(g, 'ECONOMY|Brand#2') THEN 1.0
  WHEN contains(g, 'ECONOMY') OR contains(g, 'Brand#2') THEN 0.5 ELSE 0.0 END
  + (tag_score - (SELECT min(tag_score) FROM s)) / (SELECT max(tag_score) - min(tag_score) FROM s), 9) AS score, round(rating_score, 6) AS rating_score
FROM (SELECT *, p_partkey AS item, p_type || '|' || p_brand AS g FROM part) JOIN s USING (item) JOIN best USING (item)
WHERE item IN (SELECT item FROM liked) ORDER BY score DESC, item LIMIT 30""")
def recommend(spark, sf):
    items = read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("item"),
        F.concat("p_name", F.lit(" ("), (1950 + F.col("p_size")).cast("string"), F.lit(")")).alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )
    # few customers give the full mark twice in the test tables, so every mark from 2 counts as full
    ratings = _ratings(spark, sf)
    marked = ratings.withColumn("mark", (F.col("rating") >= 2.0).cast("double"))
    liked = rec.liked_together(marked, "user", "item", "mark", _ANCHOR, 1.0)
    out = rec.rank_items(
        items, rec.tag_similarity(_tags(spark, sf), "item", "tag", _ANCHOR), liked,
        rec.avg_rating(ratings, "item", "rating"), _ANCHOR, "item", "title", "genres", floor=2.4, k=30,
        genre=lambda g: genre_score(g, "ECONOMY|Brand#2", ("ECONOMY", "Brand#2")),
    )
    return out.withColumns({"score": r("score", 9), "rating_score": r("rating_score", 6)})


# ---- evaluation on scores made from columns

@query("""WITH p AS (SELECT o_orderstatus AS y, CASE o_orderkey % 4 WHEN 0 THEN 'O' WHEN 1 THEN 'F' ELSE o_orderstatus END AS h FROM orders),
  c AS (SELECT y AS class FROM p UNION SELECT h FROM p)
SELECT class, round(coalesce(hit / nullif(said, 0), 0), 6) AS precision, round(coalesce(hit / nullif(support, 0), 0), 6) AS recall,
  round(coalesce(2 * hit / nullif(said + support, 0), 0), 6) AS f1, support, round((SELECT avg((y = h)::INT) FROM p), 6) AS accuracy
FROM (SELECT class, (SELECT count(*) FROM p WHERE y = class AND h = class) AS hit, (SELECT count(*) FROM p WHERE h = class) AS said,
  (SELECT count(*) FROM p WHERE y = class) AS support FROM c)""")
def classification_report(spark, sf):
    key = F.col("o_orderkey") % 4
    said = F.when(key == 0, "O").when(key == 1, "F").otherwise(F.col("o_orderstatus"))
    t = read_table(spark, sf, "orders").select("o_orderstatus", said.alias("said"))
    out = evaluate.classification_report(t, "o_orderstatus", "said")
    return out.withColumns({c: r(c, 6) for c in ("precision", "recall", "f1", "accuracy")})


@query("""SELECT count(*) AS n, round(avg((p - y) * (p - y)), 4) AS mse, round(sqrt(avg((p - y) * (p - y))), 4) AS rmse,
  round(avg((ln(1 + p) - ln(1 + y)) * (ln(1 + p) - ln(1 + y))), 6) AS msle,
  round(sqrt(avg((ln(1 + p) - ln(1 + y)) * (ln(1 + p) - ln(1 + y)))), 6) AS rmsle, round(avg(abs(p - y)), 4) AS mae,
  round(1 - avg((p - y) * (p - y)) / var_pop(y), 6) AS r2 FROM (SELECT value AS y, value * 0.9 + user_id % 10 AS p FROM events)""")
def regression_report(spark, sf):
    guess = F.col("value") * 0.9 + F.col("user_id") % 10
    out = evaluate.regression_report(read_table(spark, sf, "events").select("value", guess.alias("guess")), "value", "guess")
    return out.select(
        "n", *[r(c).alias(c) for c in ("mse", "rmse", "mae")], *[r(c, 6).alias(c) for c in ("msle", "rmsle", "r2")]
    )


@query("""SELECT round(avg(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END), 6) AS log_loss FROM (SELECT (event_type = 'purchase')::INT AS y,
  greatest(1e-15, least(1 - 1e-15, (event_id % 100) / 100.0)) AS p FROM events)""")
def log_loss(spark, sf):
    t = read_table(spark, sf, "events").select(
        (F.col("event_type") == "purchase").cast("int").alias("y"), ((F.col("event_id") % 100) / 100.0).alias("p")
    )
    return evaluate.log_loss(t, "y", "p").withColumn("log_loss", r("log_loss", 6))


@query("""SELECT round(sum(CASE WHEN y = 1 THEN rk END) / sum(y) / (count(*) - sum(y)) - (sum(y) + 1) / 2.0 / (count(*) - sum(y)), 6) AS auc
FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk
  FROM (SELECT (event_type = 'purchase')::INT AS y, round(value) AS s FROM events))""")
def roc_auc(spark, sf):
    t = read_table(spark, sf, "events").select(
        (F.col("event_type") == "purchase").cast("int").alias("y"), F.round("value").alias("s")
    )
    return evaluate.roc_auc(t, "y", "s").withColumn("auc", r("auc", 6))
