"""Jaccard join of word n-gram sets by group-count points.

Shingles are hashed into groups, and a document is the point of its counts per group. The sum of
coordinate minima bounds the overlap of two documents from above, and the sum of differences
bounds it too. The top of the index cuts the coordinates into blocks: similar points differ in fewer
coordinates than there are blocks, so they agree exactly in at least one block, and
equal blocks are the pages in which they meet. There are more such blocks than one, so every point leaves out
its most crowded pages. Inside pages, leaves of a tree with upper corners are
compared by the summed minima of their corners, then points, then the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainfold.llm.common import WordHasher, bounded_batches, mix64, packed, row_identity, settled_broadcast, shingle_hashes
from grainfold.llm.groups import components
from grainfold.session import passing_tables, stored

#: Coordinates of the points that are compared, and finer ones of which only the parity of the count is kept.
GROUPS, PARITIES = 64, 256


def size_bounds(most: int = 1 << 40) -> np.ndarray:
    """Lower ends of the size classes: 1, 2, 3, 4, then half as much again each time."""
    bounds = [1]
    while bounds[-1] < most:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return np.array(bounds, np.int64)


def spare_blocks(bounds: np.ndarray, differ: np.ndarray, similar: Fraction) -> np.ndarray:
    """Blocks per size class above those that similar sets need, so many that hardly any set has more empty ones.

    The smallest set that meets others in a class has ``similar`` times its lower end of shingles.
    """
    spare = differ // 10 + 2
    fewest = np.maximum(1.0, float(similar) * bounds[:-1])
    tried = spare.copy()
    while True:
        blocks = differ + 1 + tried
        empty = blocks * np.exp(-fewest / blocks)
        short = tried < empty + 3 * np.sqrt(empty) + 2
        spare = np.where(short, spare, np.where(spare > differ // 10 + 2, spare, tried))
        open_ones = short & (blocks < 2 * bounds[1:])
        if not open_ones.any():
            return spare
        tried = np.where(open_ones, tried + tried // 32 + 1, tried)


class Points:
    """Shingle sets of texts, their identity, points and pages, a batch at a time."""

    def __init__(self, width: int, similar: Fraction):
        self.width, self.similar = width, similar
        self.hasher = WordHasher()
        self.bounds = size_bounds()
        # two sets below a size differ by at most this many shingles, and there are more blocks than that
        apart = (1 - similar) / (1 + similar)
        self.differ = np.array([int(apart * 2 * (int(b) - 1)) for b in self.bounds[1:]], np.int64)
        self.spare = spare_blocks(self.bounds, self.differ, similar)
        self.blocks = self.differ + 1 + self.spare

    def sets(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes of each text in rising order, and where each text's begin."""
        value, starts = shingle_hashes(*self.hasher(texts), self.width)
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        value, owner = value[new], owner[new]
        return value, np.searchsorted(owner, np.arange(len(starts)))

    @staticmethod
    def identity(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Two 64-bit sums over each set, as an array of two columns."""
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(value ^ np.uint64(salt)))]) for salt in (0x51ED270B, 0xA24BAED4)]
        return np.stack([mix64(s[starts[1:]] - s[starts[:-1]]) for s in sums], axis=1)

    def points(self, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        flat = owner * GROUPS + (mix64(value + np.uint64(17)) % np.uint64(GROUPS)).astype(np.int64)
        return np.bincount(flat, minlength=(len(starts) - 1) * GROUPS).reshape(-1, GROUPS)

    def parities(self, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Parities of finer group counts as four 64-bit columns."""
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        flat = owner * PARITIES + (mix64(value + np.uint64(29)) % np.uint64(PARITIES)).astype(np.int64)
        odd = (np.bincount(flat, minlength=(len(starts) - 1) * PARITIES) & 1).astype(np.uint8).reshape(-1, PARITIES)
        return np.packbits(odd, axis=1).view(np.int64)

    def fine_parities(self, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64-bit words of parities of as many counts as the set has shingles (next power of two), and where each text's begin.

        With half as many counts, the parities are the first half of the words, each combined with one of the second by exclusive or.
        """
        n = np.diff(starts)
        bits = np.maximum(PARITIES, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
        ends = np.concatenate([[0], np.cumsum(bits)])
        place = (mix64(value + np.uint64(41)) & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64) + np.repeat(ends[:-1], n)
        odd = (np.bincount(place, minlength=int(ends[-1])) & 1).astype(np.uint8)
        return np.packbits(odd).view(np.int64), ends // 64

    def pages(self, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(page, text number, mark) for every block of every text, in its size class and, near the upper end, the next.

        A block is the part of the set that falls into its coordinates, coordinates being as fine as the
        hash. Empty blocks are left out: a text with no more of them than there are spare blocks agrees with any similar
        text in a block that isn't empty. Texts with more empty blocks have pages for these, too.

        The mark is the size class, above 40 bits for the number of pages that the text can do without in that class:
        similar texts agree in one block more than there are spare ones, of which the empty ones have no page.
        """
        n = np.diff(starts)
        home = np.searchsorted(self.bounds, n, side="right") - 1
        num, den = self.similar.numerator, self.similar.denominator
        out_page, out_owner, out_mark = [], [], []
        for step in (0, 1):
            use = np.flatnonzero((n > 0) if step == 0 else (n > 0) & (n * den >= num * self.bounds[home + 1]))
            kind = home[use] + step
            count = self.blocks[kind]
            base = np.concatenate([[0], np.cumsum(count)])
            take = np.repeat(starts[:-1][use] - np.concatenate([[0], np.cumsum(n[use])])[:-1], n[use]) + np.arange(int(n[use].sum()))
            text = np.repeat(np.arange(len(use)), n[use])
            v = value[take]
            block = (mix64(v + kind[text].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % count[text].astype(np.uint64)).astype(np.int64)
            flat = base[text] + block
            sums = np.zeros(int(base[-1]), np.uint64)
            np.add.at(sums, flat, mix64(v ^ np.uint64(0x6A09E667)))
            filled = np.bincount(flat, minlength=int(base[-1])) > 0
            owner = np.repeat(np.arange(len(use)), count)
            empty = np.bincount(owner[~filled], minlength=len(use))
            keep = filled | (empty > self.spare[kind])[owner]
            number = np.arange(len(owner)) - base[:-1][owner]
            label = mix64((kind[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64))
            out_page.append(mix64(sums + label)[keep])
            out_owner.append(use[owner[keep]])
            out_mark.append(((kind << 40) + np.maximum(self.spare[kind] - empty, 0))[owner[keep]])
        return np.concatenate(out_page), np.concatenate(out_owner), np.concatenate(out_mark)


def _id_bytes(identity: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(identity), [None, pa.py_buffer(np.ascontiguousarray(identity))]).cast(pa.binary())


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _need(a: Column, b: Column, similar: Fraction) -> Column:
    """Smallest overlap that makes sets of ``a`` and ``b`` shingles similar."""
    num, den = similar.numerator, similar.denominator
    return F.floor((num * (a + b) + num + den - 1) / (num + den))


def _alike(a: Column, b: Column, similar: Fraction) -> Column:
    return F.least(a, b) * similar.denominator >= F.greatest(a, b) * similar.numerator


def _minima(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)


PARITY = [f"p{i}" for i in range(PARITIES // 64)]


def _near(similar: Fraction) -> Column:
    """What two similar sets fulfil: sizes, and no more odd group counts than shingles in one set only."""
    odd = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_2"))) for p in PARITY[1:]), F.bit_count(F.col("p0").bitwiseXOR(F.col("p0_2"))))
    return _alike(F.col("n"), F.col("n_2"), similar) & (odd <= F.col("n") + F.col("n_2") - 2 * _need(F.col("n"), F.col("n_2"), similar))


def _fine_near(similar: Fraction) -> Column:
    """``_near`` by the fine parities; those of the larger set are halved if it has twice as many."""

    def halved(a: str, b: str) -> Column:
        half = (F.size(a) / 2).cast("int")
        folded = F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(a) > F.size(b), folded).otherwise(F.col(a))

    one, two = halved("fine", "fine_2"), halved("fine_2", "fine")
    odd = F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    comparable = F.greatest(F.size("fine"), F.size("fine_2")) <= 2 * F.least(F.size("fine"), F.size("fine_2"))
    return ~comparable | (odd <= F.col("n") + F.col("n_2") - 2 * _need(F.col("n"), F.col("n_2"), similar))


def _second(rows: DataFrame, *shared: str) -> DataFrame:
    """``rows`` with ``_2`` behind all names but the shared ones."""
    return rows.select(*[F.col(c) if c in shared else F.col(c).alias(f"{c}_2") for c in rows.columns])


class _Join:
    """One run of the join over the texts of ``rows`` (columns ``key``, ``text``, ``_id``, ``_tx``)."""

    def __init__(self, rows: DataFrame, width: int, similar: Fraction):
        self.rows, self.similar = rows, similar
        self.points = Points(width, similar)
        bounded_batches(rows.sparkSession)
        fields = f"key {rows.schema['key'].dataType.simpleString()}, _id long, _tx long, n long, node binary, id long, point array<int>, fine array<long>, {', '.join(f'{p} long' for p in PARITY)}"
        self.members = stored(rows.select("key", "_id", "_tx", "text").mapInArrow(self._members(), fields))
        self.marks = self.members.where("n > 0").select("id", "n", *PARITY)

    def _members(self):
        points = self.points

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                value, starts = points.sets(batch.column(3))
                identity = points.identity(value, starts)
                point = points.points(value, starts)
                parity = points.parities(value, starts)
                each = pa.ListArray.from_arrays(pa.array(np.arange(len(point) + 1, dtype=np.int32) * GROUPS), pa.array(point.ravel().astype(np.int32)))
                fine, begin = points.fine_parities(value, starts)
                finer = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(fine))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(np.diff(starts)), _id_bytes(identity), _longs(identity[:, 0].copy()), each, finer, *[pa.array(parity[:, i].copy()) for i in range(len(PARITY))]],
                    ["key", "_id", "_tx", "n", "node", "id", "point", "fine", *PARITY],
                )

        return run

    def _pages(self) -> DataFrame:
        points = self.points

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                value, starts = points.sets(batch.column(0))
                identity = points.identity(value, starts)[:, 0]
                page, owner, mark = points.pages(value, starts)
                for at in range(0, len(page), 1 << 18):
                    part = slice(at, at + (1 << 18))
                    yield pa.RecordBatch.from_arrays([_longs(page[part]), _longs(identity[owner[part]]), pa.array(mark[part])], ["page", "id", "mark"])

        return self.rows.select("text").where("text IS NOT NULL").mapInArrow(run, "page long, id long, mark long")

    def sets_of(self, pairs: DataFrame) -> DataFrame:
        """Stored ``node``, ``id`` and ``shingles`` of the sets in these pairs, from one text each."""
        points = self.points
        ids = stored(pairs.select("id").union(pairs.select("id_2")).distinct())
        chosen = self.members.select("id", "node", "_id", "_tx").join(settled_broadcast(ids, 16), "id").groupBy("node").agg(F.min(F.struct("_id", "_tx")).alias("t")).select("t.*")
        texts = self.rows.join(settled_broadcast(stored(chosen), 32), ["_id", "_tx"]).select("text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                value, starts = points.sets(batch.column(0))
                identity = points.identity(value, starts)
                shingles = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), _longs(value))
                yield pa.RecordBatch.from_arrays([_id_bytes(identity), _longs(identity[:, 0].copy()), shingles], ["node", "id", "shingles"])

        return texts.mapInArrow(run, "node binary, id long, shingles array<long>").dropDuplicates(["node"])

    def links(self) -> DataFrame:
        """Verified links (``a``, ``b``: nodes) that connect all similar sets; not all links of a group are among them.

        Each page has a hub, the member that shares most pages with others: of many variants of a text
        that is the one nearest to most of them.
        """
        placed = stored(self._placed())
        stars = stored(placed.select("id", F.col("hub").alias("id_2")).distinct())
        linked = stored(self.verified(self._possible(stars)))

        # members linked to their page's hub are settled; others meet the members of the page that links don't reach yet
        settled = linked.select("id", F.col("id_2").alias("hub"))
        open_ones = stored(placed.join(settled, ["id", "hub"], "left_anti").select("page", "id"))
        busy = open_ones.groupBy("page").agg(F.count(F.lit(1)).alias("open"))
        others = placed.join(busy, "page").select("page", "id")
        more = self.verified(self._between(open_ones, others, components(linked)))
        return linked.select("a", "b").union(more.select("a", "b"))

    def _placed(self) -> DataFrame:
        """``page``, ``id`` and ``hub`` of the members, but for the hubs, of the pages that a text can't do without.

        Similar sets share more pages than either can do without. Both leave out the most crowded ones in the same order,
        so the least crowded page that they share stays with both: no link is lost, and passages or
        phrases that many texts have make few of them meet.
        """
        # pages are made and dealt out once; copies and lonely members go where they meet
        dealt = self._pages().repartition(F.col("page")).groupBy("page", "id", "mark").agg(F.lit(1).alias("one"))
        sized = dealt.select("page", "id", "mark", F.count(F.lit(1)).over(Window.partitionBy("page")).alias("size")).where("size > 1")
        kind, spare = F.expr("shiftright(mark, 40)"), F.col("mark").bitwiseAND(F.lit((1 << 40) - 1))
        crowded = Window.partitionBy("id", "kind").orderBy(F.col("size").desc(), "page")
        needed = sized.withColumn("kind", kind).repartition(F.col("id")).withColumn("rank", F.row_number().over(crowded)).where(F.col("rank") > spare)
        weighed = needed.select("page", "id", F.sum("size").over(Window.partitionBy("id")).alias("weight"))
        hub = F.max(F.struct("weight", "id")).over(Window.partitionBy("page"))["id"]
        return weighed.select("page", "id", hub.alias("hub")).where("id <> hub")

    def _possible(self, pairs: DataFrame) -> DataFrame:
        """Pairs (``id``, ``id_2``) whose sizes and parities allow similarity."""
        marks = self.marks.distinct()
        both = pairs.join(marks, "id").join(_second(marks), "id_2")
        return both.where(_near(self.similar)).select("id", "id_2").distinct()

    def _between(self, open_ones: DataFrame, others: DataFrame, groups: DataFrame) -> DataFrame:
        """Pairs of an open member and another one of its page, not in the same of ``groups``, that the leaves' corners and the parities allow.

        A leaf holds the points of a page with the same size step and about the same sums over the first half of
        the coordinates; its upper corner has the largest value of each coordinate.
        """
        half = F.aggregate(F.slice("point", 1, GROUPS // 2), F.lit(0), lambda s, x: s + x)
        step = F.floor(F.log2(F.col("n").cast("double")) * 8)
        leaf = F.xxhash64(step, F.floor(half / F.greatest(F.lit(4.0), F.sqrt("n"))))
        wanted = others.select("id").distinct()
        distinct = self.members.where("n > 0").dropDuplicates(["node"]).join(wanted, "id").join(groups, "node", "left")
        light = stored(distinct.select("id", "n", "point", leaf.alias("leaf"), *PARITY, F.coalesce("label", "node").alias("group")))
        corners = others.join(light.drop(*PARITY, "group"), "id").groupBy("page", "leaf").agg(F.min("n").alias("n"), F.max("n").alias("most"), *[F.max(F.get("point", F.lit(i))).alias(f"c{i}") for i in range(GROUPS)])
        corners = stored(corners.select("page", "leaf", "n", "most", F.array(*[f"c{i}" for i in range(GROUPS)]).alias("corner")))
        near = corners.join(_second(corners, "page"), "page").where(
            (F.least("most", "most_2") * self.similar.denominator >= F.greatest("n", "n_2") * self.similar.numerator) & (_minima("corner", "corner_2") >= _need(F.col("n"), F.col("n_2"), self.similar))
        )
        slim = light.drop("point")
        where = open_ones.join(slim, "id").join(near.select("page", "leaf", "leaf_2"), ["page", "leaf"]).drop("leaf")
        pairs = where.join(_second(others.join(slim, "id"), "page"), ["page", "leaf_2"]).where((F.col("id") != F.col("id_2")) & (F.col("group") != F.col("group_2")) & _near(self.similar))
        return pairs.select(F.least("id", "id_2").alias("id"), F.greatest("id", "id_2").alias("id_2")).distinct()

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs that are similar, as ids and as nodes ``a`` and ``b``: by summed minima of their points and fine parities, then by the sets."""
        similar = self.similar
        pairs = stored(pairs)
        ids = stored(pairs.select("id").union(pairs.select("id_2")).distinct())
        light = self.members.where("n > 0").join(settled_broadcast(ids, 16), "id", "left_semi").dropDuplicates(["node"]).select("id", "n", "point", "fine")
        possible = pairs.join(light, "id").join(_second(light), "id_2")
        possible = stored(possible.where((_minima("point", "point_2") >= _need(F.col("n"), F.col("n_2"), similar)) & _fine_near(similar)).select("id", "id_2").distinct())
        whole = stored(self.sets_of(possible))
        both = possible.join(whole, "id").join(_second(whole), "id_2")
        n, n_2 = F.size("shingles"), F.size("shingles_2")
        overlap = F.size(F.array_intersect("shingles", "shingles_2"))
        return both.where(overlap * similar.denominator >= (n + n_2 - overlap) * similar.numerator).select("id", "id_2", F.col("node").alias("a"), F.col("node_2").alias("b"))


def join_groups(docs: DataFrame, width: int = 4, similar: Fraction = Fraction(85, 100), text: str = "text", key: str = "doc_id") -> DataFrame:
    """Groups of documents whose n-gram sets are similar: key, ``_id``, ``_tx``, ``n_shingles``, ``component_id``, ``group``.

    Words are lower-cased in A-Z and separated by white space; a document's set are its distinct runs of
    ``width`` words, or its whole sequence if it has fewer. Documents link if the Jaccard similarity of their sets is ``similar``
    or more; ``component_id`` is the smallest key that links reach, ``group`` an identifier of the group.

    Texts without words, and null texts, have size 0, are linked with nothing and have a null ``group``; rows with equal
    sets link. Null keys count in no ``component_id``; if a group has no other keys, it is null. Repeated rows
    each give a row; an empty table gives an empty result; other columns don't matter.
    """
    rows = row_identity(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text")
    with passing_tables() as keep:
        run = _Join(rows, width, similar)
        keep(run.members)
        labels = components(run.links())
        keys = run.members.where("n > 0").groupBy("node").agg(F.min("key").alias("least"))
        named = keys.join(labels, "node", "left").withColumn("group", F.coalesce("label", "node"))
        named = stored(named.select("node", "group", "least"))
        least = named.groupBy("group").agg(F.min("least").alias("component_id"))
        places = keep(stored(named.join(least, "group").select("node", "group", "component_id")))
    found = run.members.join(places, F.when(F.col("n") > 0, run.members["node"]) == places["node"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return found.select(F.col("key").alias(key), "_id", "_tx", F.col("n").alias("n_shingles"), component.alias("component_id"), "group")


def keep_one(docs: DataFrame, width: int = 5, similar: Fraction = Fraction(4, 5), text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest key (null last), by text hash if several have it.

    Of rows that agree in key and text, one stays. Documents without words all stay. All columns are kept.
    """
    with passing_tables() as keep:
        groups = keep(stored(join_groups(docs, width, similar, text, key)))
    grouped = groups.where(F.col("group").isNotNull())
    order = F.struct(F.col(key).isNull(), F.col(key), F.col("_tx"), F.col("_id")).alias("o")
    first = grouped.groupBy("group").agg(F.min(order).alias("first"))
    chosen = stored(first.select(F.col("first._id").alias("_id"), F.col("first._tx").alias("_tx")))
    wordless = groups.where(F.col("group").isNull()).select("_id", "_tx").distinct()
    again = stored(grouped.groupBy("_id", "_tx").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_id", "_tx"))
    rows = packed(docs, key, text)
    kept = rows.join(settled_broadcast(chosen, 32), ["_id", "_tx"], "left_semi")
    repeated = settled_broadcast(again, 32)
    single = kept.join(repeated, ["_id", "_tx"], "left_anti")
    once = kept.join(repeated, ["_id", "_tx"], "left_semi").dropDuplicates(["_id", "_tx"])
    empty = rows.join(settled_broadcast(stored(wordless), 32), ["_id", "_tx"], "left_semi")
    return single.select("_doc.*").unionAll(once.select("_doc.*")).unionAll(empty.select("_doc.*"))


#: The same rows in DuckDB, comparing all documents that share one of the last shingles in order of frequency.
JOIN_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
f AS (SELECT g, count(*) AS f FROM x GROUP BY g),
o AS (SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY f, g) AS i FROM x JOIN f USING (g)),
p AS (SELECT * FROM o WHERE i <= n - (85 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85),
l AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
    WHERE 100 * len(list_intersect(x.s, y.s)) >= 85 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reach FROM s UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a)
SELECT s.doc_id, CAST(coalesce(len(s.s), 0) AS BIGINT) AS n_shingles, min(reach) AS component_id FROM s JOIN r ON s.doc_id = r.node GROUP BY s.doc_id, s.s
"""
