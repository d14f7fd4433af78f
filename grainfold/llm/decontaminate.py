"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.llm.common import bound, packed, row_identity, settled_broadcast
from grainfold.session import passing_tables, stored

SHINGLE_WORDS = 5
#: Similarity 4/5 as whole numbers.
SIMILAR = (4, 5)
#: Two multisets of similarity 0.8 differ in about 10 of 64 bits, with a deviation of 3; 26 is more than five deviations off.
RADIUS = 26


def plain_words(text: Column) -> Column:
    """Lower-case runs of letters and digits; null gives none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Hashes of all runs of five words, in order; none for fewer words."""
    def runs(w: Column) -> Column:
        n = F.size(w) - SHINGLE_WORDS + 1
        hashes = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(SHINGLE_WORDS)]))
        return F.when(n > 0, hashes).otherwise(F.array().cast("array<long>"))

    return bound(words, runs)


def fingerprint(hashes: Column) -> Column:
    """64-bit SimHash: each bit is that of most hashes, repeats counted as often as they occur."""
    half = F.size(hashes)

    def with_bit(bits: Column, i: Column) -> Column:
        ones = F.size(F.filter(hashes, lambda h: F.getbit(h, i) == 1))
        return bits.bitwiseOR(F.when(ones * 2 > half, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), with_bit)


def occurrences(hashes: Column) -> Column:
    """The multiset as a set: each hash joined with the number of its occurrence."""
    return bound(F.sort_array(hashes), lambda o: F.transform(o, lambda h, i: F.xxhash64(h, i - F.array_position(o, h).cast("int"))))


def blocks(bits: Column) -> Column:
    """``RADIUS`` + 1 parts of a fingerprint. Two fingerprints within the radius agree in at least one part."""
    edges = [64 * b // (RADIUS + 1) for b in range(RADIUS + 2)]
    parts = [F.shiftrightunsigned(F.shiftleft(bits, 64 - hi), 64 - hi + lo) for lo, hi in zip(edges, edges[1:])]
    return F.array(*[F.struct(F.lit(i).alias("part"), p.alias("value")) for i, p in enumerate(parts)])


def _matches(docs: DataFrame, benchmark: DataFrame, text: str, key: str, item_text: str, item: str) -> DataFrame:
    """Verified pairs: ``_id``, ``_tx``, key, ``item_id``, ``similarity``, ``start_word``."""
    items = stored(
        benchmark.select(F.col(item).alias("item_id"), shingles(plain_words(F.col(item_text))).alias("_h"))
        .where(F.size("_h") > 0)
        .select("item_id", "_h", F.xxhash64("item_id", "_h").alias("_item"), F.size("_h").alias("_m"), fingerprint(F.col("_h")).alias("_bits"), occurrences(F.col("_h")).alias("_tags"))
    )
    anchors = stored(items.select(F.explode(F.array_distinct("_h")).alias("_hash"), "_item", "_m"))
    rows = row_identity(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_key", "_text")

    # A similar window holds at least so many places with shingles of the item. Moved on to the next such place, or to the end of the
    # text, a window loses none of them, so the best similarity is among the windows that begin there.
    placed = rows.withColumn("_h", shingles(plain_words(F.col("_text")))).select("_id", "_tx", F.size("_h").alias("_n"), F.posexplode("_h").alias("_p", "_hash"))
    shared = placed.join(settled_broadcast(anchors, 32), "_hash").groupBy("_id", "_tx", "_item", "_n", "_m").agg(F.sort_array(F.collect_set("_p")).alias("_places"))
    need = F.ceil(SIMILAR[0] * (F.least("_n", "_m") + F.col("_m")) / (SIMILAR[0] + SIMILAR[1])).cast("int")
    shared = shared.withColumn("_need", need).where(F.size("_places") >= F.col("_need"))
    last = F.greatest(F.lit(0), F.col("_n") - F.col("_m"))
    starts = F.transform("_places", lambda p, i: F.when((p < last) & (F.get("_places", i + F.col("_need") - 1) < p + F.col("_m")), p))
    starts = shared.select("_id", "_tx", F.explode(F.concat(F.array_compact(starts), F.array(last))).alias("_start"), "_m", "_item")
    starts = stored(starts.groupBy("_id", "_tx").agg(F.collect_list(F.struct("_start", "_m", "_item")).alias("_windows"), F.count(F.lit(1)).alias("_count")))
    width = starts.agg(F.sum(F.col("_count") * 24 + 48)).collect()[0][0] or 0
    near = F.broadcast(starts) if width <= 32 << 20 else starts

    hit = rows.join(near, ["_id", "_tx"]).withColumn("_h", shingles(plain_words(F.col("_text")))).select("_id", "_tx", "_key", "_h", F.explode("_windows").alias("_w"))
    windows = hit.select("_id", "_tx", "_key", F.col("_w._start").alias("_start"), F.col("_w._item").alias("_item"), F.slice("_h", F.col("_w._start") + 1, F.col("_w._m")).alias("_h"))
    windows = stored(
        windows.dropDuplicates(["_id", "_tx", "_start", "_item"]).select(
            "_id", "_tx", "_key", "_start", "_item", fingerprint(F.col("_h")).alias("_bits"), occurrences(F.col("_h")).alias("_tags")
        )
    )
    # a window meets the items whose shingles it holds, in the blocks that agree
    left = windows.select("_id", "_tx", "_start", "_item", "_bits", F.explode(blocks(F.col("_bits"))).alias("_block"))
    right = items.select("_item", F.col("_bits").alias("_item_bits"), F.explode(blocks(F.col("_bits"))).alias("_block"))
    right = settled_broadcast(stored(right), 64)
    within = F.bit_count(F.col("_bits").bitwiseXOR(F.col("_item_bits"))) <= RADIUS
    pairs = left.join(right, ["_item", "_block"]).where(within).select("_id", "_tx", "_start", "_item").distinct()

    both = pairs.join(windows.drop("_bits"), ["_id", "_tx", "_start", "_item"]).join(items.select("_item", "item_id", F.col("_tags").alias("_item_tags")), "_item")
    shared = F.size(F.array_intersect("_tags", "_item_tags"))
    union = F.size("_tags") + F.size("_item_tags") - shared
    good = both.select("_id", "_tx", "_key", "item_id", "_start", shared.alias("_shared"), union.alias("_union")).where(F.col("_shared") * SIMILAR[1] >= F.col("_union") * SIMILAR[0])
    best = F.max(F.struct((F.col("_shared") / F.col("_union")).alias("s"), (-F.col("_start")).alias("p"))).alias("_best")
    return good.groupBy("_id", "_tx", "_key", "item_id").agg(best).select("_id", "_tx", "_key", "item_id", F.col("_best.s").alias("similarity"), (-F.col("_best.p")).cast("long").alias("start_word"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item: str = "item_id") -> DataFrame:
    """Benchmark items that documents hold: key, ``item_id``, ``similarity`` (0.8 or more) and ``start_word``.

    Words are runs of letters and digits in lower case. A window has as many words as the item;
    its shingles (five words) are counted with their multiplicity, and its similarity is the sum of smaller
    counts over the sum of larger ones. Of all windows with as many shingles of an item as that similarity needs, those that
    begin on one, and the last of the text, are fingerprinted; fingerprints within ``RADIUS`` bits of the item's, all of which meet in an equal block, are verified.
    No other window is better. Given is the best of these, the first if several are best, numbered by its first word from 0.
    A document shorter than an item is one window.

    Null or short texts (fewer than five words) match nothing, on either side. Rows that agree in
    key and text count once, as do such items; null keys are kept. Empty tables give no rows; other
    columns don't matter.
    """
    return _matches(docs, benchmark, text, key, item_text, item).select(F.col("_key").alias(key), "item_id", "similarity", "start_word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows in which ``find_leaks`` finds an item; all columns are kept."""
    with passing_tables() as keep:
        found = keep(stored(_matches(docs, benchmark, text, key, "text", "item_id").select("_id", "_tx").distinct()))
    return packed(docs, key, text).join(settled_broadcast(found, 16), ["_id", "_tx"], "left_anti").select("_doc.*")


#: The same rows in DuckDB, from every window of every document that holds enough of an item's shingles.
LEAKS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
sh AS (SELECT doc_id, len(w) - 4 AS n, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s, unnest(range(0, len(w) - 4)) AS p FROM w WHERE len(w) > 4),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
ish AS (SELECT item_id, len(w) - 4 AS m, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s, unnest(range(0, len(w) - 4)) AS j FROM iw WHERE len(w) > 4),
ic AS (SELECT item_id, m, s, count(*) AS c FROM ish GROUP BY ALL),
sp AS MATERIALIZED (SELECT doc_id, item_id, n, m, p, s, c FROM sh JOIN ic USING (s)),
cand AS (SELECT doc_id, item_id, n, m FROM sp GROUP BY ALL HAVING 9 * count(*) >= 4 * (least(n, m) + m)),
wins AS (SELECT *, unnest(range(0, greatest(n - m, 0) + 1)) AS st FROM cand),
wc AS (SELECT w.doc_id, w.item_id, w.n, w.m, st, s, least(count(*), any_value(c)) AS c FROM wins w JOIN sp ON sp.doc_id = w.doc_id AND sp.item_id = w.item_id AND p >= st AND p < st + w.m GROUP BY ALL),
sums AS (SELECT doc_id, item_id, st, m, least(n, m) AS total, greatest(n - m, 0) AS last, sum(c) AS shared FROM wc GROUP BY ALL),
good AS (SELECT *, shared / (total + m - shared) AS sim FROM sums WHERE 5 * shared >= 4 * (total + m - shared)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY sim DESC, st < last AND (doc_id, item_id, st) NOT IN (SELECT doc_id, item_id, p FROM sp), st) AS r FROM good)
SELECT doc_id, item_id, CAST(sim AS DOUBLE) AS similarity, CAST(st AS BIGINT) AS start_word FROM best WHERE r = 1
"""
