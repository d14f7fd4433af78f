"""Spelling variants: words of a corpus that differ by a single edit, found by dense comparison of tiles of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.llm.common import arrow_rows, bounded_batches
from grainfold.session import stored

#: Runs of letters that are words; A to Z are lower-cased.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A run loses a letter where the hash of its document and itself is divisible by this.
LOSS = 97
#: Distinct words counted in a task before they are handed on, words of one block of a tile, and letters compared at once.
HELD, BLOCK, CELLS = 1 << 18, 512, 1 << 22


def _deleted(run: str, checksum: int) -> str:
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", loss: int | None = LOSS, least: int = 5) -> DataFrame:
    """(word, n): lower-cased runs of letters, of at least ``least`` code points after the loss of a letter.

    A run loses the code point at ``h % length`` where ``loss`` divides ``h``, the CRC-32 of key, colon and
    run; with a null key, or without ``loss``, it loses none. Counts are summed in the task first.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in arrow_rows(batches):
            for name, whole in zip(batch.column(0), batch.column(1)):
                runs = Counter(RUN.findall(whole.as_py().encode().lower().decode()))
                if loss and name.is_valid:
                    begin = zlib.crc32(f"{name.as_py()}:".encode())
                    for run, n in runs.items():
                        checksum = zlib.crc32(run.encode(), begin)
                        word = run if checksum % loss else _deleted(run, checksum)
                        if len(word) >= least:
                            held[word] += n
                else:
                    held.update({run: n for run, n in runs.items() if len(run) >= least})
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def tiles(words: DataFrame) -> DataFrame:
    """Rows of tiles: ``m``, ``side``, ``part``, ``bi``, ``bj``, ``block``, ``longer``, ``word``, ``n``.

    Of two words of ``m`` and ``m`` or ``m + 1`` letters that are a single edit apart, either the first ``m div 2``
    letters agree, or the last ``m - m div 2``. A tile holds the words that share such a part; one of more
    words than a block holds is dealt, by a hash, to blocks, and becomes a tile for each pair of them.
    """
    size = F.length("word")
    roles = F.array(*[F.struct((size - longer).alias("m"), F.lit(side).alias("side"), F.lit(longer).alias("longer")) for longer in (0, 1) for side in (0, 1)])
    rows = words.select("word", "n", F.explode(roles).alias("_r")).select("word", "n", "_r.*")
    half = F.floor(F.col("m") / 2).cast("int")
    part = F.when(F.col("side") == 0, F.substring(F.col("word"), F.lit(1), half)).otherwise(F.substring(F.col("word"), F.col("longer") + half + 1, F.col("m")))
    rows = rows.withColumn("part", part)
    where = ["m", "side", "part"]
    many = stored(rows.groupBy(*where).agg(F.count("*").alias("rows"), F.min("longer").alias("_least")).where("rows > 1 AND _least = 0").drop("_least"))
    fit = F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.floor(F.lit(CELLS) / F.col("m")))).cast("int")
    blocks = F.ceil(F.col("rows") / fit).cast("int")
    rows = rows.join(many, where).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select(*where, "block", "longer", "word", "n", other)
    return rows.select(*where, F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "longer", "word", "n")


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it in any column; the first row does."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= np.asarray(c[1:] != c[:-1], bool)
    return new


def _partners(tile: np.ndarray, second: np.ndarray, longer: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``low`` to ``high`` that each row is compared with: in its own block those behind it, else those of the second block.

    Rows are ordered by tile, block and length. Two longer words aren't compared: they meet among words of one letter more.
    """
    n, at = len(tile), np.arange(len(tile))
    ends = np.append(np.flatnonzero(np.diff(tile)) + 1, n)
    end = ends[tile]
    seconds = np.bincount(tile, weights=second, minlength=len(ends)).astype(np.int64)
    short_seconds = np.bincount(tile, weights=second & ~longer, minlength=len(ends)).astype(np.int64)
    begin = end - seconds[tile]
    low = np.where(same, at + 1, begin)
    high = np.where(same, np.where(longer, low, end), np.where(second, low, np.where(longer, begin + short_seconds[tile], end)))
    return low, high


def single_edits(words: list[str], m: int, low: np.ndarray, high: np.ndarray, prefix_side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, of those that ``low`` and ``high`` tell to compare, that are a single edit apart.

    Words have ``m`` or ``m + 1`` letters, as code points in a matrix, once from the left and once to the right end.
    A common prefix and a common suffix that together reach the longer length minus one leave one edit. Pairs whose
    first ``m div 2`` letters agree count in the tile of that prefix only.
    """
    left = np.array(words, f"U{m + 1}").view(np.uint32).reshape(len(words), m + 1)
    size = m + (left[:, m] != 0)
    right = np.where((size == m)[:, None], np.roll(left, 1, axis=1), left)[:, ::-1]
    count = high - low
    found: list[tuple[np.ndarray, np.ndarray]] = []
    most = max(1, CELLS // (m + 1))
    upto = np.cumsum(count)
    at = 0
    while at < len(count):
        done = int(upto[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + most, side="right")))
        many = count[at:end]
        a = np.repeat(np.arange(at, end), many)
        b = np.repeat(low[at:end], many) + np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
        longest = np.maximum(size[a], size[b])
        prefix = _agree(left, a, b)
        near = prefix < longest
        a, b, longest, prefix = a[near], b[near], longest[near], prefix[near]
        suffix = _agree(right, a, b)
        near = (prefix + suffix >= longest - 1) & (prefix_side[a] == (prefix >= m // 2))
        found.append((a[near], b[near]))
        at = end
    return np.concatenate([x for x, _ in found] or [np.zeros(0, int)]), np.concatenate([x for _, x in found] or [np.zeros(0, int)])


def _agree(letters: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many letters from the first column on agree."""
    differ = letters[a] != letters[b]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), letters.shape[1])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of all near pairs of the tiles of a partition, which come one behind another; no tile is cut."""

    def whole_tiles() -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        letters = 0
        for batch in arrow_rows(batches):
            held.append(batch)
            letters += int(batch.column("m").to_numpy().sum())
            if letters < CELLS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            names = ("m", "side", "part", "bi", "bj")
            last = int(np.flatnonzero(_changes(*[table.column(c).to_numpy() for c in names]))[-1])
            if last:
                yield table.slice(0, last)
            held = table.slice(last).to_batches()
            letters = int(table.column("m").slice(last).to_numpy().sum())
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    for table in whole_tiles():
        m, side, part, bi, bj = (table.column(c).to_numpy() for c in ("m", "side", "part", "bi", "bj"))
        tile = np.cumsum(_changes(m, side, part, bi, bj)) - 1
        longer, block = table.column("longer").to_numpy() == 1, table.column("block").to_numpy()
        low, high = _partners(tile, (bi != bj) & (block == bj), longer, bi == bj)
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        edges = np.append(np.flatnonzero(_changes(m)), len(m))
        for x, y in zip(edges, edges[1:]):
            a, b = single_edits(words[x:y], int(m[x]), low[x:y] - x, high[x:y] - x, side[x:y] == 0)
            one, two = np.concatenate([a, b]) + x, np.concatenate([b, a]) + x
            yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in one], pa.string()), pa.array([words[i] for i in two], pa.string()), pa.array(n[two], pa.int64())], ["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): each pair of words a single edit apart once in either direction. ``words`` is a stored table."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    where = ["m", "side", "part", "bi", "bj"]
    dealt = tiles(words).repartition(max(parts, 1), *where).sortWithinPartitions(*where, "block", "longer", "word")
    return dealt.mapInArrow(_compare, "word string, near string, near_n long")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to. ``forms`` is (word, form), without circles; words without form may be left out.

    Each round joins the pointers with themselves, so a chain of 64 words takes six rounds.
    """
    here = stored(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        on = here.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        there = stored(here.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        here = there.select("word", "root")
        if there.where("_moved").isEmpty():
            return here


def group_spellings(docs: DataFrame, key: str = "doc_id", text: str = "text", loss: int | None = LOSS, least: int = 5, least_n: int = 3, times: int = 2) -> DataFrame:
    """Words with the more frequent spelling that they vary: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are runs of letters (see :func:`count_words`) of at least ``least`` code points and ``least_n`` occurrences. Two are near
    if exactly one inserted, deleted or replaced code point parts them. ``form`` is the near word of the largest ``n`` (ties:
    the first in code-point order) if that is at least ``times`` the word's own, else null; ``root`` is where forms end.

    Near words are found by comparing blocks of words that share their first or last half, letter by letter; a half that
    many words share becomes pairs of blocks, so no task holds more than two blocks of it at once, and no pair is lost. The work
    grows with the pairs of distinct words that share a half, not with occurrences; copies of documents only raise counts.

    Null and empty texts have no words, texts and words of any length are taken whole; rows with equal or null keys count
    like others (without a key no letter is lost). An empty table gives no rows; other columns don't matter.
    """
    words = stored(count_words(docs, key, text, loss, least).where(F.col("n") >= least_n))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_b"))
    enough = -F.col("_b.n") >= times * F.col("n")
    found = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("_b.near")).alias("form"), F.when(enough, -F.col("_b.n")).alias("form_n"),
        )
    )
    return found.join(follow(found), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_LETTERS = "".join(map(chr, range(0xC0, 0x100)))
_SIGNS = "".join(chr(c) for c in range(1, 128) if not chr(c).isalpha() and chr(c) != "'")[: len(_LETTERS)]
#: One byte a letter, so that DuckDB's byte-wise distance is one of code points.
_BYTEWISE = f"translate(word, '{_LETTERS}', {' || '.join(f'chr({ord(c)})' for c in _SIGNS)})"
#: CRC-32, byte by byte through a table of 256 remainders.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode({0})) + 1), lambda i: ('0x' || substr(hex(encode({0})), 2 * i - 1, 2))::BIGINT)),
    lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8))"""
CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"


def crc_sql(value: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes in DuckDB, where a column ``crc_table`` holds :data:`CRC_TABLE`."""
    return f"xor({_CRC.format(value)}, 4294967295)"


WORDS_SQL = f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT {CRC_TABLE} AS crc_table),
runs AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, {crc_sql("(doc_id || ':' || run)")} AS h FROM runs, t),
cut AS (SELECT CASE WHEN h % {LOSS} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n, {_BYTEWISE} AS b FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
near AS MATERIALIZED (SELECT a.word, c.word AS near, c.n AS near_n FROM words a JOIN words c ON abs(length(a.b) - length(c.b)) <= 1 AND a.word <> c.word AND levenshtein(a.b, c.b) = 1),
best AS MATERIALIZED (SELECT word, count(*) AS n_near, min({{'n': -near_n, 'near': near}}) AS m FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -m.n >= 2 * n THEN m.near END AS form, CASE WHEN -m.n >= 2 * n THEN -m.n END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM forms f JOIN (SELECT walk.word, walk.root FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NULL) w ON f.word = w.word
"""
