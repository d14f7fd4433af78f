"""Log-likelihood of texts under a gated recurrent language model with a class-factored output.

Word counts cover all training texts. The most frequent words are the model's own; they sit in classes,
and a word's probability is that of its class given the state times that of the word given
class and state. All other words share a tail class, inside which counts decide. The network is trained on
every partition at once by truncated backpropagation, and weights are averaged after each round.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.llm.common import WordHasher, bounded_batches, row_identity
from grainfold.session import stored

#: Hash that stands for the end of a text.
END = np.uint64(0x454E4421)
#: Words with counts that go to all tasks, words and classes of the model, size of its state.
KNOWN_WORDS, HEAD_WORDS, CLASSES, STATE = 1 << 19, 1024, 32, 16
#: Texts side by side and steps of a window, in training and in scoring; rounds, and the share of training texts in each.
LANES, STEPS, SCORE_LANES, SCORE_STEPS = 64, 32, 384, 48
ROUNDS, SHARE = 4, 4
#: Tokens that are scored side by side, and what states may add to logits while these can do without their row's maximum.
SCORE_TOKENS, _SAFE = 1 << 22, 30.0
#: Leading bits by which words are looked up.
_LEAD = 20


def token_streams(hasher: WordHasher, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by ``END``, and where each text begins."""
    words, starts = hasher(texts)
    n = len(starts) - 1
    out_starts = starts + np.arange(n + 1)
    tokens = np.empty(len(words) + n, np.uint64)
    tokens[out_starts[1:] - 1] = END
    inside = np.ones(len(tokens), bool)
    inside[out_starts[1:] - 1] = False
    tokens[inside] = words
    return tokens, out_starts


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (hash as long) and ``c``: counts of all tokens of the column ``text``, ends of text included."""
    hasher = WordHasher()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            word = np.concatenate([h[0] for h in held])
            count = np.concatenate([h[1] for h in held])
            order = np.argsort(word, kind="stable")
            word, count = word[order], count[order]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            return pa.RecordBatch.from_arrays([pa.array(word[first].view(np.int64)), pa.array(np.add.reduceat(count, first))], ["word", "c"])

        for batch in batches:
            if not batch.num_rows:
                continue
            word, count = np.unique(token_streams(hasher, batch.column(0))[0], return_counts=True)
            held.append((word, count.astype(np.int64)))
            size += len(word)
            if size > 1 << 21:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return texts.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Frequent words in rising order of hash, their counts, and their rank among the model's words or -1."""

    word: np.ndarray
    count: np.ndarray
    rank: np.ndarray
    total: int
    distinct: int
    head_counts: np.ndarray
    begins: np.ndarray | None = None

    def look_up(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token, and whether it is there."""
        if not len(self.word):
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
        # words are hashes, so few of them share their leading bits; a token begins at the first of these
        if self.begins is None:
            self.begins = np.searchsorted(self.word >> np.uint64(64 - _LEAD), np.arange(1 << _LEAD, dtype=np.uint64))
        last = len(self.word) - 1
        at = np.minimum(self.begins[tokens >> np.uint64(64 - _LEAD)], last)
        found = self.word[at]
        behind = np.flatnonzero(found < tokens)
        while len(behind):
            at[behind] += 1
            behind = behind[at[behind] <= last]
            found[behind] = self.word[at[behind]]
            behind = behind[found[behind] < tokens[behind]]
        return np.minimum(at, last), found == tokens


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, and the words above the smallest count that no more than ``KNOWN_WORDS`` words reach."""
    steps = counts.groupBy(F.floor(F.log2("c") * 8).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"), F.min("c").alias("least"))
    steps = sorted(steps.collect(), key=lambda r: -r["s"])
    room, least = KNOWN_WORDS, None
    for step in steps:
        room -= step["n"]
        if room < 0:
            break
        least = step["least"]
    table = counts.where(F.col("c") >= least).toArrow() if least is not None else None
    word = table["word"].to_numpy().view(np.uint64) if table else np.zeros(0, np.uint64)
    count = table["c"].to_numpy() if table else np.zeros(0, np.int64)
    order = np.argsort(word)
    word, count = word[order], count[order]
    by_count = np.lexsort((word, -count))[:HEAD_WORDS]
    rank = np.full(len(word), -1, np.int32)
    rank[by_count] = np.arange(len(by_count))
    return Vocabulary(word, count, rank, sum(r["c"] for r in steps), sum(r["n"] for r in steps), count[by_count])


def class_edges(head_counts: np.ndarray) -> np.ndarray:
    """Where each class of model words begins: about equal sums of the roots of counts; classes aren't empty."""
    mass = np.cumsum(np.sqrt(head_counts))
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, CLASSES) / CLASSES) if len(mass) else []
    return np.unique(np.concatenate([[0], cuts, [len(head_counts)]]).astype(np.int64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Works in place."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


class Model:
    """The network. Inputs are ranks of model words, then the tail, then the start of a text."""

    NAMES = ("X", "Uzr", "Uh", "Wc", "bc", "Ww", "bw")

    def __init__(self, head_counts: np.ndarray, tail_count: float):
        k, h = len(head_counts), STATE
        self.k, self.edges = k, class_edges(head_counts)
        self.classes = len(self.edges)  # one more than head classes: the last is the tail
        rng = np.random.Generator(np.random.PCG64(7))
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.X, self.Uzr, self.Uh = small(k + 2, 3 * h), small(h, 2 * h), small(h, h)
        self.Wc, self.Ww = small(h, self.classes) * 0, small(k, h) * 0
        sums = np.array([head_counts[a:b].sum() for a, b in zip(self.edges, self.edges[1:])] + [tail_count], np.float64)
        self.bc = np.log(np.maximum(sums, 0.5) / np.maximum(sums, 0.5).sum()).astype(np.float32)
        self.bw = np.log(np.maximum(head_counts, 0.5)).astype(np.float32)
        self.class_of = np.concatenate([np.repeat(np.arange(self.classes - 1), np.diff(self.edges)), [self.classes - 1]]).astype(np.int64)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def step(self, h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """New states from old ones and the inputs' rows of ``X``, and what is between them."""
        zr = h @ self.Uzr
        zr += x[:, : 2 * STATE]
        zr = _sigmoid(zr)
        z, r = zr[:, :STATE], zr[:, STATE:]
        c = (r * h) @ self.Uh
        c += x[:, 2 * STATE :]
        np.tanh(c, out=c)
        new = c - h
        new *= z
        new += h
        return new, z, r, c

    def output(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each target (in the tail: of the tail class), and the gradient for the states."""
        n = np.arange(len(targets))
        kind = self.class_of[targets]
        logits = states @ self.Wc + self.bc
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        total = p.sum(axis=1)
        score = logits[n, kind] - np.log(total)
        back = None
        if grads is not None:
            p /= total[:, None]
            p[n, kind] -= 1
            back = p @ self.Wc.T
            grads["Wc"], grads["bc"] = states.T @ p, p.sum(axis=0)
            grads["Ww"], grads["bw"] = np.zeros_like(self.Ww), np.zeros_like(self.bw)
        # by class, so that a class is a slice; the tail, which is last, needs no more
        order = np.argsort(kind, kind="stable")
        ends = np.searchsorted(kind[order], np.arange(self.classes))
        order = order[: ends[-1]]
        sorted_states, kind = states[order], kind[order]
        sizes = np.diff(self.edges)
        cell = (np.arange(len(order)) - ends[kind]) * sizes[kind] + targets[order] - self.edges[kind]
        own, sums = np.empty(len(order), score.dtype), np.empty(len(order), score.dtype)
        add = np.empty_like(sorted_states) if grads is not None else None
        # states lie between -1 and 1, so this bounds what they add to a word's logit
        reach, ones = np.abs(self.Ww).sum(axis=1).max(initial=0), np.ones(max(len(order), self.k), np.float32)
        for c in range(self.classes - 1):
            at, to = ends[c], ends[c + 1]
            if at == to:
                continue
            a, b = self.edges[c], self.edges[c + 1]
            s, goal = sorted_states[at:to], cell[at:to]
            bias = self.bw[a:b]
            inner = s @ self.Ww[a:b].T
            inner += bias - bias.max()
            if reach > _SAFE:
                inner -= inner.max(axis=1, keepdims=True)
            own[at:to] = inner.ravel()[goal]
            q = np.exp(inner, out=inner)
            total = np.matmul(q, ones[: b - a], out=sums[at:to])
            if grads is not None:
                q /= total[:, None]
                q.ravel()[goal] -= 1
                np.matmul(q, self.Ww[a:b], out=add[at:to])
                grads["Ww"][a:b], grads["bw"][a:b] = q.T @ s, ones[: to - at] @ q
        score[order] += own - np.log(sums)
        if grads is not None:
            back[order] += add
        return score, back


class Lanes:
    """Texts of a batch laid out side by side: each lane is a run of whole texts, long lanes first."""

    def __init__(self, starts: np.ndarray, lanes: int):
        sizes = np.diff(starts)
        heap = [(0, i) for i in range(min(lanes, len(sizes)))]
        held: list[list[int]] = [[] for _ in heap]
        for text in np.argsort(-sizes, kind="stable"):
            load, lane = heapq.heappop(heap)
            held[lane].append(int(text))
            heapq.heappush(heap, (load + int(sizes[text]), lane))
        held = sorted(held, key=lambda texts: -sum(sizes[t] for t in texts))
        self.lengths = np.array([sum(int(sizes[t]) for t in texts) for texts in held])
        self.order = [np.concatenate([np.arange(starts[t], starts[t + 1]) for t in texts]) for texts in held]
        self.longest = int(self.lengths[0]) if len(held) else 0

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (steps x active lanes) in the token stream, -1 where a lane has ended."""
        for at in range(0, self.longest, steps):
            active = int((self.lengths > at).sum())
            width = min(steps, self.longest - at)
            places = np.full((width, active), -1, np.int64)
            for lane in range(active):
                part = self.order[lane][at : at + width]
                places[: len(part), lane] = part
            yield places


def _inputs(targets: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """What the network sees before each token, and whether a text begins there."""
    before = np.empty_like(targets)
    before[1:] = targets[:-1]
    begins = np.zeros(len(targets), bool)
    begins[starts[:-1]] = True
    before[begins] = k + 1
    return before, begins


class Adam:
    """Steps along running means of the gradients, bounded in size and in proportion to a window's tokens."""

    def __init__(self, model: Model, rate: float = 0.02, slow: float = 0.99):
        self.rate, self.slow, self.turn = rate, slow, 0
        self.mean = {n: np.zeros_like(getattr(model, n)) for n in Model.NAMES}
        self.square = {n: np.zeros_like(getattr(model, n)) for n in Model.NAMES}

    def apply(self, model: Model, grads: dict, tokens: int) -> None:
        self.turn += 1
        rate = self.rate * min(1.0, tokens / (LANES * STEPS)) * (1 - self.slow**self.turn) ** 0.5 / (1 - 0.9**self.turn)
        for name, g in grads.items():
            g = g / np.float32(max(1, tokens))
            mean, square = self.mean[name], self.square[name]
            mean += np.float32(0.1) * (g - mean)
            square += np.float32(1 - self.slow) * (g * g - square)
            getattr(model, name)[...] -= np.float32(rate) * mean / (np.sqrt(square) + np.float32(1e-5))


def train_batch(model: Model, rule: Adam, targets: np.ndarray, starts: np.ndarray) -> None:
    """One pass of truncated backpropagation over the texts of a batch."""
    lanes = Lanes(starts, LANES)
    before, begins = _inputs(targets, starts, model.k)
    h = np.zeros((len(lanes.lengths), STATE), np.float32)
    for places in lanes.windows(STEPS):
        width, active = places.shape
        valid = places >= 0
        at = np.where(valid, places, 0)
        tokens, fresh, goal = before[at], begins[at], targets[at]
        h = h[:active]
        states, olds, zs, rs, cs = (np.empty((width, active, STATE), np.float32) for _ in range(5))
        begun = fresh.any(axis=1)
        inputs = model.X[tokens]
        for t in range(width):
            olds[t] = h
            if begun[t]:
                olds[t][fresh[t]] = 0
            states[t], zs[t], rs[t], cs[t] = model.step(olds[t], inputs[t])
            h = states[t]
        use = valid.ravel()
        grads: dict[str, np.ndarray] = {}
        _, back = model.output(states.reshape(-1, STATE)[use], goal.ravel()[use], grads)
        whole = np.zeros((width * active, STATE), np.float32)
        whole[use] = back
        whole = whole.reshape(width, active, STATE)
        # what doesn't depend on later steps, for the whole window at once
        keep, by_c, by_z, by_r, used = 1 - zs, zs * (1 - cs * cs), (cs - olds) * zs * (1 - zs), olds * rs * (1 - rs), rs * olds
        into = np.empty((width, active, 3 * STATE), np.float32)
        carried = np.zeros((active, STATE), np.float32)
        zr_back, h_back = np.ascontiguousarray(model.Uzr.T), np.ascontiguousarray(model.Uh.T)
        for t in range(width - 1, -1, -1):
            d = whole[t] + carried
            dc = d * by_c[t]
            drh = dc @ h_back
            dzr = np.empty((active, 2 * STATE), np.float32)
            np.multiply(d, by_z[t], out=dzr[:, :STATE])
            np.multiply(drh, by_r[t], out=dzr[:, STATE:])
            into[t, :, : 2 * STATE], into[t, :, 2 * STATE :] = dzr, dc
            d *= keep[t]
            drh *= rs[t]
            d += drh
            d += dzr @ zr_back
            if begun[t]:
                d[fresh[t]] = 0
            carried = d
        along = into.reshape(-1, 3 * STATE)
        grads["Uzr"] = olds.reshape(-1, STATE).T @ along[:, : 2 * STATE]
        grads["Uh"] = used.reshape(-1, STATE).T @ along[:, 2 * STATE :]
        flat, rows = tokens.ravel()[use], into.reshape(-1, 3 * STATE)[use]
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) != 0]))
        grads["X"] = np.zeros_like(model.X)
        grads["X"][flat[order][first]] = np.add.reduceat(rows[order], first, axis=0)
        rule.apply(model, grads, int(use.sum()))


def score_batch(model: Model, targets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Log10-probability of each text; the state goes from window to window to the text's end."""
    lanes = Lanes(starts, SCORE_LANES)
    before, begins = _inputs(targets, starts, model.k)
    h = np.zeros((len(lanes.lengths), STATE), np.float32)
    each = np.zeros(len(targets))
    for places in lanes.windows(SCORE_STEPS):
        width, active = places.shape
        valid = places >= 0
        at = np.where(valid, places, 0)
        tokens, fresh = before[at], begins[at]
        h = h[:active]
        states = np.empty((width, active, STATE), np.float32)
        begun = fresh.any(axis=1)
        inputs = model.X[tokens]
        for t in range(width):
            if begun[t]:
                h = np.where(fresh[t][:, None], np.float32(0), h)
            h = model.step(h, inputs[t])[0]
            states[t] = h
        use = valid.ravel()
        each[places.ravel()[use]] = model.output(states.reshape(-1, STATE)[use], targets[at].ravel()[use])[0]
    return np.add.reduceat(each, starts[:-1]) / np.log(10) if len(starts) > 1 else np.zeros(0)


def _targets(known: Vocabulary, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each token (tail words: the number of model words), its place and whether it is known."""
    at, here = known.look_up(tokens)
    rank = np.where(here, known.rank[at] if len(known.rank) else -1, -1)
    return np.where(rank >= 0, rank, len(known.head_counts)).astype(np.int64), at, here


def train(texts: DataFrame, known: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """Weights after one round: each task trains a copy on its texts; copies are averaged by their tokens."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(cloudpickle.dumps((known, weights)))
    pieces = 64
    hasher = WordHasher()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start = pickle.loads(shared.value)
        model = Model(words.head_counts, words.total - float(words.head_counts.sum()))
        model.load(start)
        rule = Adam(model)
        seen = 0
        for batch in batches:
            if batch.num_rows:
                tokens, starts = token_streams(hasher, batch.column(0))
                train_batch(model, rule, _targets(words, tokens)[0], starts)
                seen += len(tokens)
        if seen:
            parts = np.array_split(model.flat().astype(np.float64) * seen, pieces)
            yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array([float(seen)] * pieces), pa.array([p.tobytes() for p in parts], pa.binary())], ["piece", "n", "w"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(w, np.float64) for w in rows["w"].to_pylist())
        return pa.table({"piece": pa.array([rows["piece"][0].as_py()], pa.int32()), "w": pa.array([(total / sum(rows["n"].to_pylist())).tobytes()], pa.binary())})

    trained = texts.select("text").mapInArrow(run, "piece int, n double, w binary")
    found = trained.groupBy("piece").applyInArrow(add, "piece int, w binary").collect()
    if len(found) < pieces:
        return weights
    return np.concatenate([np.frombuffer(r["w"], np.float64) for r in sorted(found, key=lambda r: r["piece"])]).astype(np.float32)


def held_out(key: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether the CRC-32 of the key's text has remainder ``fold``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


def score_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Log10-probability of every whole text, learned from the rows that aren't held out.

    Gives the key, ``held_out``, ``n_tokens`` (words and the end), ``n_known`` (those that training has), ``train_tokens``,
    ``base_score`` (add-half word counts) and ``score`` (the network). Words are lower-cased in A-Z and
    told apart by 64-bit hashes. Counts of words that aren't frequent enough to be sent to all tasks are joined.
    Each round trains on another quarter of the training rows, by hash of the key, and the rounds go through all of them.

    Null text counts as empty and is scored as an end alone. Repeated rows are scored each; null keys are kept; if
    there is nothing to learn from, all scores are 0. Other columns don't matter.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    training = row_identity(rows.where(~F.col("held_out")), "key", "text")
    counts = stored(count_words(training))
    known = vocabulary(counts)
    tail = known.total - float(known.head_counts.sum())
    model = Model(known.head_counts, tail)
    weights = model.flat()
    for turn in range(ROUNDS if known.total else 0):
        weights = train(training.where(F.pmod("_id", F.lit(SHARE)) == turn), known, weights)
    shared = spark.sparkContext.broadcast(cloudpickle.dumps((known, weights)))
    hasher = WordHasher()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, learned = pickle.loads(shared.value)
        model = Model(words.head_counts, words.total - float(words.head_counts.sum()))
        model.load(learned)
        log_count = np.log10(words.count + 0.5)
        next_row = TaskContext.get().partitionId() << 40
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            """Texts of several batches side by side, so that the longest of each don't run alone."""
            shifts = np.cumsum([0] + [len(t) for _, t, _ in held])
            starts = np.concatenate([[0]] + [s[1:] + shift for (_, _, s), shift in zip(held, shifts)])
            net = score_batch(model, np.concatenate([t for _, t, _ in held]), starts)
            ends = np.cumsum([len(s) - 1 for _, _, s in held])[:-1]
            for (columns, _, _), part in zip(held, np.split(net, ends)):
                yield pa.RecordBatch.from_arrays([*columns, pa.array(part)], names=["key", "held_out", "row", "n_tokens", "known", "logs", "tail_logs", "n_tail", "rare", "net"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, starts = token_streams(hasher, batch.column(1))
            targets, at, here = _targets(words, tokens)
            add = lambda x, starts=starts: np.add.reduceat(x, starts[:-1])
            logs = np.where(here, log_count[at] if len(log_count) else 0.0, 0.0)
            in_tail = targets == len(words.head_counts)
            owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[~here]
            other = tokens[~here]
            order = np.lexsort((other, owner))
            owner, other = owner[order], other[order]
            first = np.flatnonzero(np.concatenate([[True], (other[1:] != other[:-1]) | (owner[1:] != owner[:-1])])) if len(other) else np.zeros(0, np.int64)
            times = np.diff(np.append(first, len(other)))
            cuts = np.searchsorted(owner[first], np.arange(len(starts))).astype(np.int32)
            rare = pa.StructArray.from_arrays([pa.array(other[first].view(np.int64)), pa.array(times.astype(np.int32))], ["word", "times"])
            columns = [
                batch.column(0), batch.column(2), pa.array(next_row + np.arange(batch.num_rows)), pa.array(np.diff(starts)), pa.array(add(here.astype(np.int64))),
                pa.array(add(logs)), pa.array(add(logs * in_tail)), pa.array(add(in_tail.astype(np.int64))), pa.ListArray.from_arrays(pa.array(cuts), rare),
            ]
            held.append((columns, targets, starts))
            next_row += batch.num_rows
            if sum(len(t) for _, t, _ in held) >= SCORE_TOKENS:
                yield from flush()
                held.clear()
        if held:
            yield from flush()

    kind = rows.schema["key"].dataType.simpleString()
    fields = f"key {kind}, held_out boolean, row long, n_tokens long, known long, logs double, tail_logs double, n_tail long, rare array<struct<word: long, times: int>>, net double"
    scored = stored(rows.select("key", "text", "held_out").mapInArrow(run, fields))
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.times").alias("times")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rare = rare.groupBy("row").agg(F.sum(F.col("times") * F.log10(c + 0.5)).alias("rare_logs"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    base = float(np.log10(known.total + 0.5 * (known.distinct + 1)))
    tail_base = float(np.log10(tail + 0.5 * (known.distinct - len(known.head_counts) + 1)))
    logs = F.coalesce("rare_logs", F.lit(0.0))
    return scored.drop("rare").join(rare, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"), F.lit(int(known.total)).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * base).alias("base_score"), (F.col("net") + F.col("tail_logs") + logs - F.col("n_tail") * tail_base).alias("score"),
    )
