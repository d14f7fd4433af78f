"""Mixing sources to target weights by thresholds on a hash of the document key.

Targets come from the sizes of the sources; which documents fill them follows from
histograms of a fixed hash, so no rows are sorted and reruns take the same documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grainfold.llm.common import word_count
from grainfold.session import stored

#: The hash has 60 bits, refined 15 bits at a time.
HASH_BITS, LEVEL_BITS = 60, 15


def key_hash(key: Column) -> Column:
    """60 bits of the MD5 of a key's text; a null key hashes as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, most: int) -> DataFrame:
    """Target per source: ``budget`` times all sizes by weight, at most ``most`` times a source's size.

    ``sizes`` has ``source`` and ``source_size``. Weights repeat over the sources in code point
    order, null last. What a full source can't take goes to the others by weight: in order of
    capacity per weight, a source is full if its share of what the earlier ones leave exceeds it.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("_fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before, rest = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    return (
        sizes.withColumn("_n", F.row_number().over(by_source) - 1)
        .withColumn("_weight", weight)
        .withColumn("_most", most * F.col("source_size").cast("double"))
        .withColumn("_fill", F.col("_most") / F.col("_weight"))
        .withColumn("_all", budget * F.sum("source_size").over(everything).cast("double"))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / F.sum("_weight").over(rest))
        .withColumn("_level", F.max(F.when(F.col("_fill") > F.col("_level"), F.col("_level"))).over(everything))
        .withColumn("target", F.coalesce(F.least("_most", F.col("_level") * F.col("_weight")), F.col("_most")))
        .select("source", "source_size", "target")
    )


def _limits(base: DataFrame, weights: Sequence[float], budget: float, most: int) -> DataFrame:
    """Per source ``_s``: ``source_size``, ``target``, how often all documents are taken, and the hash below which once more."""
    totals = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(totals, weights, budget, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = stored(plan.withColumn("_whole", whole).withColumn("_left", F.col("target") - F.col("_whole") * F.col("source_size")))

    # edge: the hash prefix whose bucket holds the threshold; _below: words in smaller buckets
    edges = plan.select("source", "_left", F.lit(0).cast("long").alias("_edge"), F.lit(0).cast("long").alias("_below"))
    shift = HASH_BITS
    while shift > 0:
        finer = shift - LEVEL_BITS
        inside = base.select("source", "_hash", "size").join(
            edges.select(F.col("source").alias("_s"), "_edge"), F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("_hash", shift) == F.col("_edge")) & (F.col("size") > 0)
        )
        counts = inside.groupBy("source", F.shiftright("_hash", finer).alias("_bucket")).agg(F.sum("size").alias("_words"))
        over = (
            counts.withColumn("_to", F.sum("_words").over(Window.partitionBy("source").orderBy("_bucket")))
            .join(edges.select(F.col("source").alias("_s"), "_left", "_below"), F.col("source").eqNullSafe(F.col("_s")))
            .where(F.col("_below") + F.col("_to") > F.col("_left"))
            .groupBy("_s")
            .agg(F.min(F.struct("_bucket", "_to", "_words", "_left", "_below")).alias("_first"))
        )
        below = F.col("_first._below") + F.col("_first._to") - F.col("_first._words")
        edges = stored(over.select(F.col("_s").alias("source"), F.col("_first._left").alias("_left"), F.col("_first._bucket").alias("_edge"), below.alias("_below"), F.col("_first._words").alias("_words")))
        shift = finer
    # the documents at the threshold itself come along if that is nearer to the target
    nearer = F.col("_below") + F.col("_words") - F.col("_left") < F.col("_left") - F.col("_below")
    ends = edges.select(F.col("source").alias("_s"), (F.col("_edge") + nearer.cast("long")).alias("_limit"))
    limit = F.when(F.col("_left") > 0, F.coalesce("_limit", F.lit(1 << HASH_BITS))).otherwise(0).alias("_limit")
    return plan.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left").select(F.col("source").alias("_s"), "source_size", "target", "_whole", limit)


def mix_documents(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), budget: float = 1.5, most: int = 2, text: str = "text", key: str = "doc_id", source: str = "source"
) -> DataFrame:
    """``docs`` as the struct ``_doc``, with what the mix takes of each row.

    Gives ``_doc``, ``source``, ``size`` (words), ``source_size``, ``target`` (of the source) and ``taken`` (words, repeats
    counted), one row per input row. Each document is taken as often as its source's target holds the whole source, and once
    more if its hash is below the source's threshold: the place where the sum of sizes in hash order comes nearest to what
    is left. ``most`` bounds how often a document is taken.

    Null or blank texts have size 0 and take nothing; a null source is a source of its own, last
    in order; rows with equal keys share a hash and are taken together; an empty table gives an
    empty result. Other columns don't matter, whatever their names.
    """
    measured = [F.col(source).alias("source"), word_count(F.col(text)).alias("size"), key_hash(F.col(key)).alias("_hash")]
    limits = stored(_limits(stored(docs.select(*measured)), weights, budget, most))
    taken = F.col("size") * (F.col("_whole") + (F.col("_hash") < F.col("_limit")).cast("long"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *measured)
    return rows.join(limits, F.col("source").eqNullSafe(F.col("_s"))).select("_doc", "source", "size", "source_size", "target", taken.alias("taken"))


def mix_sources(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Key, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` of each row, as ``mix_documents`` has them."""
    mixed = mix_documents(docs, key=key, **options)
    return mixed.select(F.col(f"_doc.`{key}`").alias(key), "source", "size", "source_size", "target", "taken")


#: The same rows in DuckDB, with the default weights.
MIX_SQL = r"""
WITH base AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
    FROM {documents}
), totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
weighted AS (
    SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS w, 2.0::DOUBLE * source_size AS most FROM totals
), levels AS (
    SELECT *, most / w AS fill,
        (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY most / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
), targets AS (
    SELECT source, source_size, coalesce(least(most, max(level) FILTER (WHERE fill > level) OVER () * w), most) AS target FROM levels
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS n FROM targets
), ordered AS (
    SELECT b.*, p.source_size, p.target, p.n, p.target - p.n * p.source_size AS left_over,
        sum(b.size) OVER (PARTITION BY b.source ORDER BY b.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
        sum(b.size) OVER (PARTITION BY b.source, b.h) AS here
    FROM base b JOIN parts p ON b.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, source, size, source_size, target,
    CAST(size * (n + CASE WHEN left_over > 0 AND (upto <= left_over OR upto - left_over < left_over - (upto - here)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""
