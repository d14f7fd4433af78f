"""Queries through files: test tables are written as text and read back by the readers."""

from __future__ import annotations

import struct
import zlib

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from grainfold.functions.dates import epoch_seconds
from grainfold.operators.ordered import OrderedGroups
from grainfold.operators.split import cap_per_class
from grainfold.plans.registry import query, r
from grainfold.session import scratch
from grainfold.sources import files, readers, writers
from grainfold.sources.readers import read_table


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderdate FROM orders")
def scan_csv(spark, sf):
    path = scratch(spark, "scan_csv")
    rows = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    rows.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string, o_orderdate timestamp_ntz"
    return readers.scan_csv(spark, path, schema)


@query("SELECT n_nationkey AS id, n_name AS output, n_regionkey AS region FROM nation")
def csv_roundtrip(spark, sf):
    path = scratch(spark, "csv_roundtrip")
    names = {"n_nationkey": "id", "n_name": "output", "n_regionkey": "region"}
    writers.write_csv(read_table(spark, sf, "nation"), path, names, sep=";")
    return readers.scan_csv(spark, path, "id int, output string, region int", sep=";")


@query("""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type
FROM events""")
def scan_nulls(spark, sf):
    path, key = scratch(spark, "scan_nulls"), F.col("event_id")
    text = read_table(spark, sf, "events").select(
        "event_id", F.when(key % 7 != 0, F.col("value").cast("string")).otherwise("?").alias("value"),
        F.when(key % 5 != 0, F.col("event_type")).otherwise("?").alias("event_type"),
    )
    writers.write_csv(text, path, sep=";")
    return readers.scan_csv(spark, path, "event_id bigint, value double, event_type string", sep=";", null="?")


@query("SELECT c_custkey::VARCHAR AS id, c_mktsegment AS segment, c_acctbal::DOUBLE AS balance FROM customer")
def scan_headerless(spark, sf):
    path = scratch(spark, "scan_headerless")
    read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").write.csv(path)
    rows = readers.scan_headerless(spark, path, 5, {0: "id", 4: "segment", 3: "balance"})
    return rows.withColumn("balance", F.col("balance").try_cast("double"))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^\x{00}-\x{ff}]', '?', 'g'), '\s+', ' ', 'g')) AS text FROM documents
WHERE length(trim(regexp_replace(text, '\s+', ' ', 'g'))) > 0""")
def scan_latin1(spark, sf):
    path = scratch(spark, "scan_latin1")
    line = F.trim(F.regexp_replace(F.regexp_replace("text", r"[^\x00-\xff]", "?"), r"\s+", " "))
    rows = read_table(spark, sf, "documents").select("doc_id", line.alias("text")).where(F.length("text") > 0)
    rows.write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    return readers.scan_csv(spark, path, "doc_id bigint, text string", encoding="ISO-8859-1")


@query(r"""SELECT line, count(*) AS n FROM (SELECT regexp_replace(unnest(regexp_split_to_array(text, '\r\n|\r|\n')), '^\s+|\s+$', '', 'g') AS line FROM documents)
WHERE line <> '' GROUP BY line""")
def scan_lines(spark, sf):
    path = scratch(spark, "scan_lines")
    read_table(spark, sf, "documents").select("text").write.text(path)
    return readers.scan_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT (event_id % 50)::DOUBLE AS page, value AS x0, event_id::DOUBLE AS y0, value + 10 AS x1, event_id + 12.0 AS y1, event_type AS word FROM events""")
def scan_tokens(spark, sf):
    path, key, v = scratch(spark, "scan_tokens"), F.col("event_id"), F.col("value")
    boxes = [key % 50, v, key, v + 10, key + F.lit(12.0)]
    line = F.concat_ws("  ", *[b.cast("string") for b in boxes], "event_type")
    read_table(spark, sf, "events").select(line).write.text(path)
    return readers.scan_tokens(spark, path).select("page", "x0", "y0", "x1", "y1", "word")


@query(r"""SELECT lang AS label, length(t) AS n_chars, count(*) AS n FROM (SELECT lang, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents)
GROUP BY 1, 2""")
def split_corpus(spark, sf):
    path = scratch(spark, "split_corpus")
    rows = read_table(spark, sf, "documents").select("lang", "text")
    # one folder per label; the marker stands between texts
    rows.write.partitionBy("lang").option("lineSep", readers.CORPUS_MARK).text(path)
    texts = readers.split_corpus(spark, path, label_pattern=r"lang=([^/]+)/")
    return texts.groupBy("label", F.length("text").alias("n_chars")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1.0::DOUBLE AS code, 1.0::DOUBLE AS ones FROM orders""")
def model_roundtrip(spark, sf):
    path = scratch(spark, "model_roundtrip")
    rows = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    stages = [
        StringIndexer(inputCol="o_orderpriority", outputCol="code", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="code", outputCol="hot", dropLast=False),
    ]
    writers.save_model(Pipeline(stages=stages).fit(rows), path)
    out = writers.load_model(path).transform(rows)
    ones = F.aggregate(vector_to_array("hot"), F.lit(0.0), lambda a, x: a + x)
    return out.select("o_orderkey", "code", ones.alias("ones"))


@query("SELECT vec_id, len(embedding) AS width, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings")
def array_files(spark, sf):
    """Vectors written as array files and read again in ranges of rows; the key is each row's first value."""
    path = scratch(spark, "array_files")
    rows = read_table(spark, sf, "embeddings")
    files.write_arrays(rows.select(F.concat(F.array(F.col("vec_id").cast("double")), F.col("embedding").cast("array<double>")).alias("v")), "v", path)
    found = files.read_arrays(spark, path, range_bytes=100_000)
    rest = F.slice("values", 2, F.size("values") - 1)
    total = F.aggregate(rest, F.lit(0.0), lambda a, x: a + x)
    return found.select(F.col("values")[0].cast("long").alias("vec_id"), F.size(rest).cast("long").alias("width"), r(total).alias("total"))


@query("""SELECT user_id::VARCHAR AS file_id, epoch_us(ts) / 1e6 AS "start", epoch_us(ts) / 1e6 + value AS "end" FROM events""")
def json_sidecars(spark, sf):
    """JSON side files in a folder per user, with a segment for each of up to 1,000 events, read back as segments."""
    path = scratch(spark, "json_sidecars")
    at = epoch_seconds(F.col("ts"))
    segment = F.struct(at.alias("start_time"), (at + F.col("value")).alias("end_time"))
    # numbered inside the user, so that a file has 1,000 events wherever there are so many, however the ids are spread
    rows = OrderedGroups(read_table(spark, sf, "events").select("event_id", "user_id", "ts", "value"), ["user_id"], ["event_id"]).position("_pos").frame()
    sides = rows.groupBy("user_id", F.floor((F.col("_pos") - 1) / 1000).alias("n")).agg(F.collect_list(segment).alias("speech_segments"))
    body = F.to_json(F.struct("speech_segments")).cast("binary")
    files.write_files(sides.select(F.concat(F.concat_ws("/", "user_id", "n"), F.lit(".json")).alias("name"), body.alias("content")), path)
    return readers.json_segments(spark, path, r"([^/]+)/[^/]+\.json$")


def _png(red, green, blue):
    """Column of one-pixel PNG files."""

    @F.udf("binary")
    def picture(*pixel):
        def chunk(kind, data):
            return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

        head = struct.pack(">IIBBBBB", 1, 1, 8, 2, 0, 0, 0)
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(bytes([0, *pixel]))) + chunk(b"IEND", b"")

    return picture(red, green, blue)


@query("""SELECT s_nationkey::VARCHAR AS label, count(*) AS n, sum(s_suppkey % 256 * 65536 + s_suppkey // 256 % 256 * 256 + s_nationkey)::BIGINT AS pixels
FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey || '.png') AS place FROM supplier) WHERE place <= 800 GROUP BY s_nationkey""")
def image_folders(spark, sf):
    """A picture per supplier in its nation's folder, read back with labels, at most 800 a label."""
    path = scratch(spark, "image_folders")
    key = F.col("s_suppkey")
    rows = read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", _png((key % 256).cast("int"), (F.floor(key / 256) % 256).cast("int"), F.col("s_nationkey").cast("int")).alias("content"))
    files.write_files(rows.select(F.concat_ws("/", "s_nationkey", F.concat(key.cast("string"), F.lit(".png"))).alias("name"), "content"), path)
    found = readers.labelled_images(spark, path)
    kept = cap_per_class(found.withColumn("origin", F.col("image.origin")), "label", "origin", 800)
    # Spark keeps the bytes of a pixel as blue, green, red
    byte = [F.conv(F.hex(F.substring("image.data", i, 1)), 16, 10).cast("long") for i in (3, 2, 1)]
    return kept.groupBy("label").agg(F.count("*").alias("n"), F.sum(byte[0] * 65536 + byte[1] * 256 + byte[2]).alias("pixels"))
