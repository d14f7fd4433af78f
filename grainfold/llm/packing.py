"""Packing token sequences along a space-filling curve, so that neighbours in a sequence are alike."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.llm.common import arrow_rows, bounded_batches
from grainfold.operators.ranges import key_bounds, range_count, range_of, range_starts
from grainfold.session import stored

#: Hash buckets of a document's vector, dimensions it is projected to, bits of each, and bits that part equal documents.
BUCKETS, DIMS, BITS, TIE_BITS = 1024, 3, 14, 21
#: Tokens that one range of the curve should hold.
RANGE_TOKENS = 1 << 23
#: Characters encoded at once, and the longest run without blanks for the faster engine.
PIECE, LONG_RUN = 1 << 20, 10_000

#: A blank after a character that is no blank in any table: no token reaches over it, and what is right of it doesn't depend on what is left.
_CUT = re.compile(r"(?<=[^\s᠎])[ \t\n\r]")
#: Fixed value: the pattern that byte-level tokenizers of this kind split texts by.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_encoder(data: bytes) -> Callable[[str], np.ndarray]:
    """Function from a text to its ids as the tokenizers library gives them for a JSON file's bytes.

    A plain byte-level BPE whose ids follow the order of its merges is run by tiktoken with that
    file's vocabulary, at about a quarter of the time; other files, and texts with very long runs
    without blanks, are run by tokenizers itself. Strings of special tokens give those tokens.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_str(data.decode())
    slow.no_truncation()
    slow.no_padding()

    def exact(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    spec = json.loads(data)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    bare = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    bytewise = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and spec["normalizer"] is None
    if not (model["type"] == "BPE" and bytewise and bare and not model.get("dropout") and not model.get("ignore_merges")):
        return exact
    vocab = {w: i for w, i in model["vocab"].items() if w not in special}
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged) or len(vocab) != len(merged) + 256:
        return exact
    import tiktoken

    of = _byte_of()
    fast = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks={bytes(of[c] for c in w): i for w, i in vocab.items()}, special_tokens=special)
    run = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

    def encode(text: str) -> np.ndarray:
        if len(text) >= LONG_RUN and run.search(text):
            return exact(text)
        return fast.encode_to_numpy(text, allowed_special="all")

    return encode


def encode_whole(encode: Callable[[str], np.ndarray], text: str) -> np.ndarray:
    """Ids of a text of any length, worked out in pieces that end where no token can go on."""
    if len(text) <= PIECE:
        return encode(text)
    parts, at = [], 0
    while at < len(text):
        cut = _CUT.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        parts.append(encode(text[at:end]))
        at = end
    return np.concatenate(parts)


def projection(buckets: int, dims: int) -> np.ndarray:
    """Fixed random directions of the projection."""
    return np.random.Generator(np.random.PCG64(41)).standard_normal((buckets, dims))


def document_points(ids: list[np.ndarray], buckets: int, dims: int, bits: int) -> np.ndarray:
    """Grid points of documents: hashed id counts under a square root, of length one, projected; coordinates are cut off at 4."""
    owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    flat = np.concatenate(ids).astype(np.uint64) if ids else np.zeros(0, np.uint64)
    bucket = ((flat * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(buckets)
    vectors = np.sqrt(np.bincount(owner * buckets + bucket.astype(np.int64), minlength=len(ids) * buckets).reshape(len(ids), buckets))
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    place = (vectors / np.maximum(length, 1e-12)) @ projection(buckets, dims)
    top = (1 << bits) - 1
    return np.clip((place + 4) / 8 * top, 0, top).astype(np.int64)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid points along the Hilbert curve, by Skilling's transposition of the axes."""
    axes = [points[:, i].copy() for i in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for axis in axes:
            turned = (axis >> level) & 1 == 1
            swap = np.where(turned, 0, (axes[0] ^ axis) & below)
            axis ^= swap
            axes[0] ^= np.where(turned, below, swap)
    for before, axis in zip(axes, axes[1:]):
        axis ^= before
    turn = np.zeros(len(points), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros(len(points), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << 1 | ((axis ^ turn) >> level) & 1
    return key


def tail_bounds(rest: int) -> list[int]:
    """Ends of the sequences that hold the last ``rest`` tokens: powers of two, the largest first, so that none is padded."""
    ends, at = [], 0
    for power in range(rest.bit_length() - 1, -1, -1):
        if rest >> power & 1:
            at += 1 << power
            ends.append(at)
    return ends


def cut_pieces(begin: np.ndarray, size: np.ndarray, total: int, length: int) -> dict[str, np.ndarray]:
    """Pieces of documents that lie one behind another: ``owner``, ``start``, ``length``, ``sequence_id`` and ``offset``."""
    full = total // length
    tail = np.concatenate([[0], tail_bounds(total - full * length)]).astype(np.int64) + full * length

    def sequence_of(at: np.ndarray) -> np.ndarray:
        return np.where(at < full * length, at // length, full + np.searchsorted(tail, at, side="right") - 1)

    def first_of(sequence: np.ndarray) -> np.ndarray:
        return np.where(sequence <= full, sequence * length, tail[np.clip(sequence - full, 0, len(tail) - 1)])

    first, last = sequence_of(begin), sequence_of(begin + size - 1)
    count = last - first + 1
    owner = np.repeat(np.arange(len(begin)), count)
    sequence = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    low = np.maximum(begin[owner], first_of(sequence))
    high = np.minimum((begin + size)[owner], first_of(sequence + 1))
    high = np.where(sequence == last[owner], (begin + size)[owner], high)
    return {"owner": owner, "start": low - begin[owner], "length": high - low, "sequence_id": sequence, "offset": low - first_of(sequence)}


def pack_documents(
    docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, dims: int = DIMS, bits: int = BITS,
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens: key, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Each document is the ids of its whole text and ``end_id``. Its hashed id counts are projected to
    a few dimensions, and documents are laid one behind another in the order of their places on a
    Hilbert curve; that line is cut every ``length`` tokens. What is left at its end is cut at powers
    of two, so no sequence needs padding. ``ids`` are little-endian unsigned 32-bit numbers.

    Texts are encoded once, into a table in the shared folder. Ranges of the curve have bounds
    counted from that table, and tokens before each range are a sum per range, so a range is
    packed by itself. Equal documents, however many, are parted by a hash of their keys.

    Null and empty texts are ``end_id`` alone. Very long texts are encoded in pieces and cut like
    others. Rows with equal keys, or none, are documents of their own; equal places are ordered by
    key (nulls first) and ids, so reruns agree. An empty table gives no pieces; other columns don't matter.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = load_encoder(model.value)
        for batch in arrow_rows(batches):
            ids, places, held = [], [], 0
            pending: list[np.ndarray] = []
            for i, one in enumerate(batch.column(1)):
                found = np.append(encode_whole(run, one.as_py()), np.uint32(end_id))
                pending.append(found)
                held += 1
                if held == 512 or i == batch.num_rows - 1:
                    places.append(hilbert_keys(document_points(pending, buckets, dims, bits), bits))
                    ids += pending
                    pending, held = [], 0
            small = all(int(x.max()) < 1 << 16 for x in ids)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.concatenate(places)),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([small] * len(ids)),
                    pa.array([x.astype(np.uint16 if small else np.uint32).tobytes() for x in ids], pa.binary()),
                ],
                ["key", "place", "n", "small", "ids"],
            )

    encoded = rows.mapInArrow(encode, f"key {kind}, place long, n long, small boolean, ids binary")
    tie = F.xxhash64("key").bitwiseAND((1 << TIE_BITS) - 1)
    table = stored(encoded.withColumn("place", F.shiftleft("place", TIE_BITS).bitwiseOR(tie)))
    tokens = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bounds = key_bounds(table, "place", range_count(spark, tokens, RANGE_TOKENS))
    ranges = len(bounds) + 1
    numbered = table.withColumn("range", range_of(F.col("place"), bounds))
    starts = range_starts(numbered, "range", F.col("n"), ranges)
    total = int(starts[-1])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = -1, 0
        for batch in arrow_rows(batches):
            number, size = batch.column("range").to_numpy(), batch.column("n").to_numpy()
            begin = np.cumsum(size) - size
            new = np.flatnonzero(np.diff(number, prepend=here))
            base = np.full(len(size), at, np.int64)
            for i in new:
                base[i:] = starts[number[i]] - begin[i]
            begin = begin + base
            here, at = number[-1], int(begin[-1] + size[-1])
            found = cut_pieces(begin, size, total, length)
            owner, low, many = found["owner"], found["start"], found["length"]
            raw, small = batch.column("ids").to_pylist(), batch.column("small").to_pylist()
            wide = [np.frombuffer(x, np.uint16 if s else np.uint32).astype("<u4") for x, s in zip(raw, small)]
            ids = pa.array([wide[o][a : a + m].tobytes() for o, a, m in zip(owner, low, many)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(owner)), pa.array(low), pa.array(many), ids, pa.array(size[owner]), pa.array(found["sequence_id"]), pa.array(found["offset"])],
                ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    dealt = numbered.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "place", "key", "ids")
    pieces = dealt.mapInArrow(cut, f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return pieces.withColumnRenamed("key", key)
