"""Row-wise queries: projections, filters, strings, dates, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainfold.functions import arrays, dates, numeric, text
from grainfold.operators import clean, encode, lookup, split
from grainfold.plans.registry import query, r
from grainfold.sources.readers import read_table


@query("""SELECT l_orderkey AS order_id, l_partkey AS part_id, l_quantity AS quantity, l_returnflag AS flag
FROM lineitem""")
def project(spark, sf):
    t = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    return t.withColumnsRenamed(
        {"l_orderkey": "order_id", "l_partkey": "part_id", "l_quantity": "quantity", "l_returnflag": "flag"}
    )


@query("""SELECT o_orderkey, round(o_totalprice * 1000 / 60, 4) AS scaled, o_totalprice - 1000 AS above,
  round(sqrt(o_totalprice), 4) AS root, abs(o_totalprice - 200000) AS distance,
  floor(o_totalprice / 100000)::INT + 1.0 AS size_plus_one FROM orders""")
def derive_cols(spark, sf):
    price = F.col("o_totalprice")
    return read_table(spark, sf, "orders").select(
        "o_orderkey", r(price * 1000 / 60).alias("scaled"), (price - 1000).alias("above"),
        r(F.sqrt(price)).alias("root"), F.abs(price - 200000).alias("distance"),
        (F.floor(price / 100000) + F.lit(1.0)).alias("size_plus_one"),
    )


@query("""SELECT l_orderkey, l_partkey, l_linenumber,
  round(CASE WHEN l_tax = 0 THEN 0 ELSE l_discount / l_tax END, 6) AS ratio,
  round(CASE WHEN l_extendedprice = 0 THEN 0 ELSE (l_extendedprice - 1000 * l_quantity) / l_extendedprice END, 6) AS margin,
  (l_discount > 0)::INT AS has_discount FROM lineitem""")
def guarded_ratio(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        r(numeric.guarded_ratio(F.col("l_discount"), F.col("l_tax")), 6).alias("ratio"),
        r(numeric.margin(F.col("l_extendedprice"), 1000 * F.col("l_quantity")), 6).alias("margin"),
        (F.col("l_discount") > 0).cast("int").alias("has_discount"),
    )


@query("""SELECT CASE WHEN l_quantity < 5 THEN 0 WHEN l_quantity < 20 THEN 1 ELSE 2 END AS qty_bin, count(*) AS n
FROM lineitem GROUP BY 1""")
def bin_counts(spark, sf):
    t = read_table(spark, sf, "lineitem")
    return t.groupBy(numeric.bin_by(F.col("l_quantity"), [5, 20]).alias("qty_bin")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
WHERE l_extendedprice <> 0 AND l_quantity < 5 AND l_returnflag IN ('A', 'R')""")
def filter_rows(spark, sf):
    return (
        read_table(spark, sf, "lineitem")
        .where((F.col("l_extendedprice") != 0) & (F.col("l_quantity") < 5) & F.col("l_returnflag").isin("A", "R"))
        .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    )


@query("""SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)""")
def extreme_rows(spark, sf):
    t = read_table(spark, sf, "orders")
    top = t.select(F.max("o_totalprice")).scalar()
    return t.where(F.col("o_totalprice") == top).select("o_orderkey", "o_totalprice")


@query("""SELECT p_partkey, CASE WHEN contains(g, 'ECONOMY|Brand#2') THEN 1.0
  WHEN contains(g, 'ECONOMY') OR contains(g, 'Brand#2') THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM (SELECT p_partkey, p_type || '|' || p_brand AS g FROM part)""")
def rule_score(spark, sf):
    genres = F.concat_ws("|", "p_type", "p_brand")
    return read_table(spark, sf, "part").select(
        "p_partkey", text.genre_score(genres, "ECONOMY|Brand#2", ("ECONOMY", "Brand#2")).alias("score")
    )


@query("""SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def fill_const(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id")
    return docs.join(read_table(spark, sf, "labels"), "doc_id", "left").fillna({"quality": -1, "toxic": 0})


@query("""SELECT event_id, round(coalesce(try_cast(trim(raw) AS DOUBLE), value * user_id), 4) AS amount
FROM (SELECT *, CASE event_id % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'n/a' ELSE value::VARCHAR END AS raw FROM events)""")
def safe_cast_fallback(spark, sf):
    rest = F.pmod(F.col("event_id"), F.lit(5))
    raw = F.when(rest == 0, " ").when(rest == 1, "n/a").otherwise(F.col("value").cast("string"))
    return read_table(spark, sf, "events").select(
        "event_id", r(numeric.safe_double(raw, F.col("value") * F.col("user_id"))).alias("amount")
    )


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
  WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END AS level FROM orders""")
def remap_category(spark, sf):
    levels = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}
    return read_table(spark, sf, "orders").select(
        "o_orderkey", numeric.remap(F.col("o_orderpriority"), levels).alias("level")
    )


@query("""SELECT s AS sentinel, (SELECT count(*) FROM lineitem WHERE l_tax::VARCHAR = s) AS n
FROM (VALUES ('-1.0'), ('0.0'), ('0.08'), ('999999.99')) v(s)""")
def sentinel_audit(spark, sf):
    t = read_table(spark, sf, "lineitem").select(F.col("l_tax").cast("string").alias("tax"))
    return clean.sentinel_audit(t, "tax", ["-1.0", "0.0", "0.08", "999999.99"])


@query("""SELECT doc_id, source FROM (SELECT doc_id, CASE WHEN doc_id % 97 = 0 THEN 'source'
  WHEN doc_id % 89 = 0 THEN NULL ELSE source END AS source FROM documents) WHERE source IS DISTINCT FROM 'source'""")
def drop_header_rows(spark, sf):
    key = F.col("doc_id")
    planted = F.when(key % 97 == 0, "source").when(key % 89 == 0, None).otherwise(F.col("source"))
    t = read_table(spark, sf, "documents").select("doc_id", planted.alias("source"))
    return clean.drop_header_rows(t, "source")


@query("""SELECT nullif(event_id, 1) AS event_id, nullif(user_id, 1) AS user_id, nullif(event_type, '1') AS event_type, nullif(value, 1) AS value
FROM events""")
def sentinel_nulls(spark, sf):
    t = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return clean.sentinels_to_null(t, 1)


@query("""SELECT 'labelled' AS part, count(quality) AS n FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'unlabelled', count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""")
def split_labelled(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id")
    known, unknown = clean.split_labelled(docs.join(read_table(spark, sf, "labels"), "doc_id", "left"), "quality")
    count = F.count(F.lit(1)).alias("n")
    return known.agg(count).select(F.lit("labelled").alias("part"), "n").union(
        unknown.agg(count).select(F.lit("unlabelled"), "n")
    )


# ---- unions and distinct rows

@query("""SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::BIGINT AS rank FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_suppkey % 10 FROM supplier""")
def union_by_name(spark, sf):
    a = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    b = read_table(spark, sf, "supplier").select(
        (F.col("s_suppkey") % 10).alias("rank"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return a.unionByName(b, allowMissingColumns=True)


@query("""SELECT c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""")
def union_common(spark, sf):
    a = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    b = read_table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return clean.union_common(a, b)


@query("""SELECT o_orderkey AS key, o_totalprice AS amount, 1.0::DOUBLE AS booked FROM orders
UNION ALL SELECT event_id, value, 0.0::DOUBLE FROM events""")
def union_flagged(spark, sf):
    booked = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    seen = read_table(spark, sf, "events").select(F.col("event_id").alias("key"), F.col("value").alias("amount"))
    return clean.union_flagged({1.0: booked, 0.0: seen}, "booked")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def dedupe(spark, sf):
    return read_table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").dropDuplicates()


# ---- strings

@query(r"""SELECT page_id, nullif(split_part(url, '/', 4), '') AS site_lang, split_part(url, '/', -1) AS last,
  lower(split_part(url, '/', 3)) AS host, CASE WHEN len(string_split(url, '/')) > 9 THEN split_part(url, '/', 10) END AS deep
FROM pages""")
def string_parts(spark, sf):
    url = F.col("url")
    return read_table(spark, sf, "pages").select(
        "page_id", F.nullif(text.part(url, "/", 3), F.lit("")).alias("site_lang"), text.part(url, "/", -1).alias("last"),
        F.lower(text.part(url, "/", 2)).alias("host"), text.part(url, "/", 9).alias("deep"),
    )


@query(r"""SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 0 ELSE len(string_split(text, ' ')) END AS n_words FROM documents
WHERE length(text) > 0""")
def list_size(spark, sf):
    words = F.when(F.col("doc_id") % 11 != 0, F.col("text"))
    return read_table(spark, sf, "documents").where(F.length("text") > 0).select(
        "doc_id", text.list_size(words, " ").alias("n_words")
    )


@query(r"""SELECT doc_id, array_to_string(w[1:greatest(len(w) - 3, 0)], ' ') AS text
FROM (SELECT doc_id, string_split(replace(text, chr(133), ''), ' ') AS w FROM documents)""")
def trim_tokens(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", text.drop_last_tokens(F.col("text")).alias("text"))


# Person names and sexes made from the customer table, in both engines alike.
_TITLES = ["Mr", "Mrs", "Miss", "Master", "Don", "Lady", "the Countess", "Col", "Capt", "Mme", "Ms", "Rev", "Dr", "Mlle"]
_FIRST = ['Ellen "Nellie"', 'John "Jack Boy" Tim', 'Max/Moritz "x" Paul', 'Anna "Annie" (Mary Ann)', "Jane (Mary)"]
_PEOPLE = f"""(SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'male' ELSE 'female' END AS sex,
  concat(c_name, ', ', ([{", ".join(f"'{x}'" for x in _TITLES)}])[(c_custkey % 14 + 1)::INT], '. ',
  ([{", ".join(f"'{x}'" for x in _FIRST)}])[(c_custkey % 5 + 1)::INT]) AS name FROM customer)"""


def _people(spark, sf):
    key = F.col("c_custkey")
    pick = lambda items, n: F.element_at(F.array(*[F.lit(x) for x in items]), (key % n + 1).cast("int"))
    return read_table(spark, sf, "customer").select(
        "c_custkey", F.when(key % 3 == 0, "male").otherwise("female").alias("sex"),
        F.concat("c_name", F.lit(", "), pick(_TITLES, 14), F.lit(". "), pick(_FIRST, 5)).alias("name"),
    )


@query(f"""SELECT c_custkey, CASE WHEN NOT contains(n, '"') THEN n
  WHEN length(split_part(n, '"', 2)) > 1 AND NOT contains(n, '(') AND NOT contains(n, ')') AND NOT contains(split_part(n, '"', 2), ' ')
    THEN split_part(n, '"', 1) || split_part(n, '"', 3)
  ELSE replace(n, '"', '') END AS name FROM (SELECT c_custkey, replace(name, '/', '-') AS n FROM {_PEOPLE})""")
def clean_quotes(spark, sf):
    return _people(spark, sf).select("c_custkey", text.clean_quotes(F.col("name")).alias("name"))


_TITLE_SQL = "trim(split_part(split_part(name, ',', 2), '.', 1))"


@query(f"""SELECT c_custkey, CASE WHEN t IN ('Don', 'Lady', 'Sir', 'the Countess', 'Jonkheer', 'Dona') THEN 'Noble'
  WHEN t IN ('Major', 'Col', 'Capt') THEN 'Military' WHEN t IN ('Miss', 'Mlle', 'Ms') THEN 'Miss'
  WHEN t IN ('Mme', 'Mrs') THEN 'Mrs' ELSE t END AS title, contains(name, '(')::INT AS changed_name
FROM (SELECT *, {_TITLE_SQL} AS t FROM {_PEOPLE})""")
def title_bucket(spark, sf):
    return _people(spark, sf).select(
        "c_custkey", text.title_bucket(F.col("name")).alias("title"),
        F.col("name").contains("(").cast("int").alias("changed_name"),
    )


@query(f"""SELECT c_custkey, ((t IN ('Don', 'Sir', 'Jonkheer', 'Rev', 'Major', 'Col', 'Capt', 'Mr', 'Master') AND sex = 'male')
  OR (t IN ('Dona', 'Lady', 'the Countess', 'Mrs', 'Miss', 'Mme', 'Ms', 'Mlle') AND sex = 'female'))::INT AS consistent
FROM (SELECT *, {_TITLE_SQL} AS t FROM {_PEOPLE})""")
def consistency_flag(spark, sf):
    return _people(spark, sf).select(
        "c_custkey", text.title_agrees(F.col("name"), F.col("sex")).alias("consistent")
    )


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN 1950 + p_size END AS year FROM part""")
def title_year(spark, sf):
    key = F.col("p_partkey")
    tail = F.when(key % 7 == 0, " (Part 2)").otherwise(F.concat(F.lit(" ("), 1950 + F.col("p_size"), F.lit(')"')))
    return read_table(spark, sf, "part").select(
        "p_partkey", text.title_year(F.concat("p_name", tail)).alias("year")
    )


@query("""SELECT p_partkey, p_brand || ' ' || p_name AS text, concat_ws('::', p_type, p_size::VARCHAR) AS code FROM part""")
def concat_cols(spark, sf):
    return read_table(spark, sf, "part").select(
        "p_partkey", F.concat("p_brand", F.lit(" "), "p_name").alias("text"),
        F.concat_ws("::", "p_type", F.col("p_size").cast("string")).alias("code"),
    )


@query(r"""SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}_\s]', ' ', 'g') AS text FROM documents""")
def clean_tokens(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", text.clean_token(F.col("text")).alias("text"))


@query("""SELECT p_partkey, CASE WHEN lower(p_brand) <= lower(p_name) THEN p_brand || p_name ELSE p_name || p_brand END AS code
FROM part""")
def pair_code(spark, sf):
    return read_table(spark, sf, "part").select(
        "p_partkey", text.pair_code(F.col("p_brand"), F.col("p_name")).alias("code")
    )


# ---- dates, JSON, arrays

@query("""SELECT event_id, date_trunc('second', ts) AS plain, date_trunc('second', ts) AS iso,
  date_trunc('second', ts) AS time_first, NULL::TIMESTAMP AS broken FROM events""")
def parse_ts(spark, sf):
    ts = F.col("ts")
    return read_table(spark, sf, "events").select(
        "event_id", dates.parse_ts(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("plain"),
        dates.parse_ts(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), dates.ISO).alias("iso"),
        dates.parse_ts(F.date_format(ts, "H:m:s'::'d/M/yyyy"), dates.TIME_FIRST).alias("time_first"),
        dates.parse_ts(F.date_format(ts, "dd.MM.yyyy")).alias("broken"),
    )


@query("""SELECT o_orderkey, year(d) AS year, month(d) AS month, isodow(d) - 1 AS weekday, dayofyear(d) AS day_of_year,
  hour(d) AS hour, minute(d) AS minute,
  CASE WHEN o_orderkey % 3 = 0 THEN (CASE WHEN 2001 >= year(d) THEN datediff('day', d, TIMESTAMP '2001-01-01') ELSE 0 END)
    ELSE o_orderkey % 50 END AS days_to_return, (o_orderkey % 3 <> 0)::INT::DOUBLE AS has_return
FROM (SELECT o_orderkey, o_orderdate AS d FROM orders)""")
def date_features(spark, sf):
    key, d = F.col("o_orderkey"), F.col("o_orderdate")
    back = F.date_format(d + F.make_dt_interval((key % 50).cast("int")), "yyyy-MM-dd'T'HH:mm:ss")
    legs = F.when(key % 3 != 0, F.concat(back, F.lit(";1999-01-01T00:00:00")))
    t = read_table(spark, sf, "orders").withColumn("legs", legs)
    return t.select(
        "o_orderkey", *[c.alias(n) for n, c in dates.calendar_parts(d).items()],
        dates.days_until(dates.first_leg(F.col("legs")), d, True).cast("long").alias("days_to_return"),
        F.col("legs").isNotNull().cast("double").alias("has_return"),
    )


@query("""SELECT event_id, json_extract(props, '$.k')::INT AS k, json_extract_string(props, '$.none') AS missing FROM events""")
def json_props(spark, sf):
    parsed = F.from_json("props", "k int, none string")
    return read_table(spark, sf, "events").select(
        "event_id", parsed["k"].alias("k"), parsed["none"].alias("missing")
    )


@query("""SELECT event_id, n, start_time, start_time + value AS end_time
FROM (SELECT event_id, value, unnest([0, 1]) AS n, unnest([event_id * 10.0, event_id * 10.0 + 1000.5])::DOUBLE AS start_time FROM events)""")
def json_segments(spark, sf):
    key, v = F.col("event_id") * F.lit(10.0), F.col("value")
    segment = lambda s: F.struct(s.alias("start_time"), (s + v).alias("end_time"))
    raw = F.to_json(F.struct(F.array(segment(key), segment(key + 1000.5)).alias("speech_segments")))
    schema = "speech_segments array<struct<start_time: double, end_time: double>>"
    t = read_table(spark, sf, "events").select("event_id", F.from_json(raw, schema)["speech_segments"].alias("s"))
    return t.select("event_id", F.posexplode("s").alias("n", "s")).select("event_id", "n", "s.*")


@query("""SELECT vec_id, array_to_string(list_concat(list_transform(range(0, greatest(100 - len(v), 0)), lambda x: 0),
  v[greatest(len(v) - 99, 1):]), ' ') AS padded FROM (SELECT vec_id,
  list_transform(CASE WHEN vec_id % 2 = 0 THEN embedding ELSE list_concat(embedding, embedding) END, lambda x: (floor(x * 100))::INT) AS v FROM embeddings)""")
def pad_sequence(spark, sf):
    twice = F.when(F.col("vec_id") % 2 == 0, F.col("embedding")).otherwise(F.concat("embedding", "embedding"))
    ids = F.transform(twice, lambda x: F.floor(x * F.lit(100).cast("float")).cast("int"))
    padded = arrays.left_pad(ids, 100)
    return read_table(spark, sf, "embeddings").select(
        "vec_id", F.array_join(F.transform(padded, lambda x: x.cast("string")), " ").alias("padded")
    )


@query("""SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / n, 6) AS one, round(embedding[1] / sqrt(n), 6) AS first
FROM (SELECT vec_id, embedding, list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) AS n FROM embeddings)""")
def l2_norm(spark, sf):
    unit = arrays.l2_normalize(F.col("embedding"))
    t = read_table(spark, sf, "embeddings").select("vec_id", unit.alias("u"))
    return t.select("vec_id", r(arrays.l2_norm(F.col("u")), 6).alias("one"), r(F.col("u")[0], 6).alias("first"))


# ---- categories

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("SELECT c_custkey, " + ", ".join(
    f"(c_mktsegment = '{s}')::INT AS c_mktsegment_{s}" for s in _SEGMENTS if s != "MACHINERY") + " FROM customer")
def one_hot(spark, sf):
    t = read_table(spark, sf, "customer")
    found = encode.levels(t, "c_mktsegment")
    wide = encode.one_hot(t.select("c_custkey", "c_mktsegment"), "c_mktsegment", found, drop="MACHINERY")
    return wide.drop("c_mktsegment")


@query("""SELECT o_orderkey, coalesce(code - 1, -1)::INT AS priority_code FROM
(SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS priority FROM orders) o
LEFT JOIN (SELECT o_orderpriority AS p, dense_rank() OVER (ORDER BY o_orderpriority) AS code FROM (SELECT DISTINCT o_orderpriority FROM orders)) c
ON o.priority = c.p""")
def category_codes(spark, sf):
    known = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")).alias("priority")
    t = read_table(spark, sf, "orders").select("o_orderkey", known)
    return encode.category_codes(t, ["priority"]).drop("priority")


@query("""SELECT c_custkey, coalesce(i, (SELECT count(DISTINCT c_mktsegment) FROM customer WHERE c_custkey % 2 = 0))::DOUBLE AS label
FROM customer LEFT JOIN (SELECT c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS i
  FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_custkey % 2 = 0)) USING (c_mktsegment)""")
def label_index(spark, sf):
    t = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    model = encode.label_indexer(t.where("c_custkey % 2 = 0"), "c_mktsegment")
    return model.transform(t).select("c_custkey", "label")


@query("""SELECT doc_id, round(1.0 / count(*) OVER (PARTITION BY lang), 8) AS inverse,
  CASE lang WHEN 'fr' THEN 10.0 WHEN 'de' THEN 30.0 ELSE 1.0 END::DOUBLE AS weight FROM documents""")
def class_weight(spark, sf):
    t = read_table(spark, sf, "documents").select("doc_id", "lang")
    t = encode.class_weight(encode.class_weight(t, "lang", name="inverse"), "lang", {"fr": 10, "de": 30})
    return t.select("doc_id", r("inverse", 8).alias("inverse"), "weight")


@query("""SELECT l_orderkey, l_partkey, l_linenumber, 4 AS width,
  round(l_quantity + l_extendedprice + l_discount + l_tax, 4) AS total FROM lineitem""")
def assemble(spark, sf):
    from pyspark.ml.functions import vector_to_array

    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    v = vector_to_array("features")
    rows = encode.assemble(read_table(spark, sf, "lineitem"), keys)
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.size(v).alias("width"), r(v[0] + v[1] + v[2] + v[3]).alias("total")
    )


# ---- splits

_BUCKET = "(concat('0x', substr(md5({}::VARCHAR), 1, 8))::BIGINT % 100)"


@query(f"""SELECT o_orderkey, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'valid' ELSE 'test' END AS part
FROM (SELECT o_orderkey, {_BUCKET.format("o_orderkey")} AS b FROM orders)""")
def hash_split(spark, sf):
    t = read_table(spark, sf, "orders").select("o_orderkey")
    return split.hash_split(t, "o_orderkey", {"train": 70, "valid": 15, "test": 15})


@query(f"""SELECT part, lang, count(*) AS n FROM (SELECT lang, CASE WHEN b < 60 THEN 'train' ELSE 'test' END AS part
FROM (SELECT lang, {_BUCKET.format("doc_id")} AS b FROM documents)) GROUP BY part, lang""")
def split_coverage(spark, sf):
    t = split.hash_split(read_table(spark, sf, "documents"), "doc_id", {"train": 60, "test": 40})
    return split.split_coverage(t, "part", "lang")


@query("""SELECT event_id % 7 AS fold, (concat('0x', substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 5)::INT AS hashed, count(*) AS n
FROM events GROUP BY 1, 2""")
def kfold(spark, sf):
    t = split.modulo_fold(read_table(spark, sf, "events"), "event_id", 7)
    return split.hash_fold(t, "event_id", 5, "hashed").groupBy("fold", "hashed").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k
FROM documents) WHERE k <= 10""")
def cap_per_class(spark, sf):
    return split.cap_per_class(read_table(spark, sf, "documents").select("doc_id", "source"), "source", "doc_id", 10)


@query("""SELECT lang, count(*) AS n FROM documents GROUP BY lang HAVING count(*) < (SELECT count(*) / 5.0 FROM documents)""")
def class_shortfall(spark, sf):
    t = read_table(spark, sf, "documents").select("lang")
    share = t.select(F.count(F.lit(1)) / 5.0).scalar()
    return split.class_shortfall(t, "lang", share)


@query("""SELECT doc_id, 'paragraph_' || (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) AS in_source,
  'paragraph_' || (row_number() OVER (ORDER BY doc_id) - 1) AS in_table FROM documents""")
def surrogate_id(spark, sf):
    t = read_table(spark, sf, "documents").select("doc_id", "source")
    t = split.surrogate_id(t, ["source"], ["doc_id"], "paragraph_", "in_source")
    return split.surrogate_id(t, [], ["doc_id"], "paragraph_", "in_table").drop("source")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 20")
def preview_slice(spark, sf):
    t = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return split.preview_slice(t, ["o_orderkey"], 20, 10)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30")
def top_k(spark, sf):
    t = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return split.top_k(t, "o_totalprice", "o_orderkey", 30)
