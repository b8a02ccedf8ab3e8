"""Scoring texts by a log-bilinear model trained by noise-contrastive estimation."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import batch_of, byte_words, crc_remainder, single_thread, stored, texts_of, tree_sum

_COUNTS = pa.schema([("word", pa.string()), ("c", pa.int64())])
_SCORED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
    ("rare", pa.list_(pa.string())),
])
_SCORED_SQL = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "rare array<string>"
)
# Distinct words that a task holds before it passes its counts on.
_HELD = 300_000


@dataclass(frozen=True)
class Shape:
    """Sizes of the model: none of them grows with the corpus.

    ``known`` bounds the words that are copied to the executors with their counts; all others are
    looked up by a join. The ``heads`` most frequent are output classes of their own, the rest
    fall into classes by their last two letters: the ``endings`` most frequent ones, and one more.
    """

    known: int = 200_000
    heads: int = 895
    endings: int = 127
    width: int = 24
    noise: int = 32
    batch: int = 4096
    rate: float = 0.08
    rounds: int = 2
    seed: int = 1


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the training tokens: in full as a table, and the part that every task holds."""

    table: DataFrame = field(repr=False)  # word, c: the words that are not known
    words: dict[bytes, int]  # known words by rank
    counts: np.ndarray  # of the known words
    heads: int
    endings: dict[str, int]
    tokens: int  # N
    kinds: int  # V
    ends: int  # training documents, each of which ends once
    class_counts: np.ndarray
    class_words: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.class_counts)

    @property
    def end(self) -> int:
        return self.classes - 1

    def shared(self) -> Vocabulary:
        """What tasks need of it."""
        return Vocabulary(None, *(getattr(self, f) for f in list(self.__dataclass_fields__)[1:]))


def token_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over all texts: counted in each task, then summed by word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = batch_of(_COUNTS, {"word": [w.decode() for w in held], "c": list(held.values())})
            held.clear()
            return out

        for (texts,) in (part for batch in batches for part in texts_of(batch)):
            for text in texts:
                held.update(byte_words(text))
                if len(held) > _HELD:
                    yield flush()
        yield flush()

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def learn_vocabulary(docs: DataFrame, shape: Shape) -> Vocabulary:
    """Count all tokens of ``docs`` and divide the words into known, heads and classes by ending."""
    table = stored(token_counts(docs).withColumn("size", F.floor(F.log2("c") * 8).cast("int")), "words")
    # Words by size of their count: a few hundred rows at most.
    sizes = sorted(
        map(tuple, table.groupBy("size").agg(F.count(F.lit(1)), F.sum("c")).collect()), reverse=True
    )
    held, least = 0, (sizes[0][0] + 1 if sizes else 0)
    for size, words, _ in sizes:
        if held + words > shape.known:
            break
        held, least = held + words, size
    # At most shape.known words.
    known = sorted(map(tuple, table.where(F.col("size") >= least).select("word", "c").collect()),
                   key=lambda r: (-r[1], r[0]))
    heads = known[: shape.heads]
    ending = table.groupBy(F.right("word", F.lit(2)).alias("ending")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")
    )
    frequent = list(map(tuple, ending.orderBy(F.desc("c"), "ending").limit(shape.endings).collect()))
    endings = {e: i for i, (e, _, _) in enumerate(frequent)}
    tokens, kinds = sum(s[2] for s in sizes), sum(s[1] for s in sizes)
    counts = np.zeros((len(endings) + 1, 2))
    counts[:-1] = [(c, n) for _, c, n in frequent] if frequent else counts[:-1]
    counts[-1] = (tokens - sum(c for _, c, _ in frequent), kinds - sum(n for *_, n in frequent))
    for word, c in heads:
        counts[endings.get(word[-2:], len(endings))] -= (c, 1)
    ends = docs.count()
    return Vocabulary(
        table.where(F.col("size") < least).select("word", "c"),
        {w.encode(): i for i, (w, _) in enumerate(known)},
        np.array([c for _, c in known], dtype=np.float64),
        len(heads), endings, tokens + ends, kinds + (ends > 0), ends,
        np.concatenate([[c for _, c in heads], counts[:, 0], [ends]]),
        np.concatenate([np.ones(len(heads)), counts[:, 1], [1]]),
    )


class _Codes(dict):
    """A known word's rank, or minus one minus the class by ending of any other word."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary.words)
        self._endings, self._base = vocabulary.endings, len(vocabulary.words)

    def __missing__(self, word: bytes) -> int:
        code = -1 - self._endings.get(word.decode()[-2:], len(self._endings))
        if len(self) < self._base + _HELD:
            self[word] = code
        return code


class Reader:
    """Texts as codes of words, and codes as classes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._codes = _Codes(vocabulary)
        by_ending = [
            vocabulary.heads + vocabulary.endings.get(w.decode()[-2:], len(vocabulary.endings))
            for w in list(vocabulary.words)[vocabulary.heads:]
        ]
        self._class = np.concatenate([np.arange(vocabulary.heads), by_ending]).astype(np.int32)

    def codes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._codes.__getitem__, words), dtype=np.int32, count=len(words))

    def classes(self, codes: np.ndarray) -> np.ndarray:
        found = np.empty(len(codes), dtype=np.int32)
        known = codes >= 0
        found[known] = self._class[codes[known]]
        found[~known] = self.vocabulary.heads - 1 - codes[~known]
        return found

    def events(self, texts: Iterable[np.ndarray]) -> np.ndarray:
        """Rows (second last, last, this) of classes for each token and end; before a text: start."""
        end, start = self.vocabulary.end, self.vocabulary.classes
        parts = []
        for classes in texts:
            padded = np.concatenate([[start, start], classes, [end]]).astype(np.int32)
            parts.append(np.stack([padded[:-2], padded[1:-1], padded[2:]], axis=1))
        return np.concatenate(parts) if parts else np.zeros((0, 3), dtype=np.int32)


@dataclass
class LogBilinear:
    """s(w | u, v) = (a * R[u] + b * R[v]) . T[w] + bias[w], for the last class v and u before it."""

    context: np.ndarray  # R: a row per class, and one for the start
    target: np.ndarray  # T
    bias: np.ndarray
    scales: np.ndarray  # a and b

    @classmethod
    def fresh(cls, shape: Shape, class_counts: np.ndarray) -> LogBilinear:
        """Small vectors, and biases that make the model the class frequencies."""
        draw, classes = np.random.default_rng(shape.seed), len(class_counts)
        return cls(
            draw.normal(0, 0.1, (classes + 1, shape.width)).astype(np.float32),
            draw.normal(0, 0.1, (classes, shape.width)).astype(np.float32),
            np.log(_noise(class_counts)).astype(np.float32),
            np.ones((2, shape.width), dtype=np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.bias, self.scales]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()]).astype(np.float64)

    def like(self, flat: np.ndarray) -> LogBilinear:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return LogBilinear(*out)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (second last, class), by (last, class), and log normalisers by both contexts.

        The normaliser of all pairs of contexts is one product of two matrices, as the score is a
        sum of a part from each.
        """
        far = (self.scales[0] * self.context) @ self.target.T
        near = (self.scales[1] * self.context) @ self.target.T + self.bias
        far_top, near_top = far.max(axis=1), near.max(axis=1)
        sums = np.exp((far - far_top[:, None]).astype(np.float64)) @ np.exp((near - near_top[:, None]).astype(np.float64)).T
        normal = np.log(sums) + far_top[:, None] + near_top[None, :]
        return far, near, normal


def _noise(class_counts: np.ndarray) -> np.ndarray:
    return (class_counts + 1.0) / (class_counts + 1.0).sum()


def _add_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.add.reduceat(values[order], first, axis=0)


class Trainer:
    """Noise-contrastive steps: tell each token from ``noise`` classes drawn by frequency."""

    def __init__(self, model: LogBilinear, class_counts: np.ndarray, shape: Shape, seed: int):
        self.model, self.shape = model, shape
        self._draw = np.random.default_rng(seed)
        noise = _noise(class_counts)
        self._cumulative = np.cumsum(noise)
        self._log_noise = (np.log(noise) + np.log(shape.noise)).astype(np.float32)
        self._squares = [np.full(p.shape[0] if p.ndim > 1 else p.shape, 1e-4, np.float32) for p in model.parts()]

    def _step(self, part: int, rows: np.ndarray, gradient: np.ndarray) -> None:
        """Ascend along the gradient, each row's step shortened by its squares so far."""
        value, squares = self.model.parts()[part], self._squares[part]
        size = np.mean(gradient**2, axis=1) if gradient.ndim > 1 else gradient**2
        squares[rows] += size
        scale = self.shape.rate / np.sqrt(squares[rows])
        value[rows] += gradient * (scale[:, None] if gradient.ndim > 1 else scale)

    def learn(self, events: np.ndarray) -> None:
        for low in range(0, len(events), self.shape.batch):
            self._learn(events[low:low + self.shape.batch])

    def _learn(self, events: np.ndarray) -> None:
        m = self.model
        far, near, word = events[:, 0], events[:, 1], events[:, 2]
        drawn = np.minimum(
            np.searchsorted(self._cumulative, self._draw.random(self.shape.noise)), len(m.bias) - 1
        )
        r_far, r_near = m.context[far], m.context[near]
        query = m.scales[0] * r_far + m.scales[1] * r_near
        t_word, t_drawn = m.target[word], m.target[drawn]
        true = np.einsum("ij,ij->i", query, t_word) + m.bias[word] - self._log_noise[word]
        false = query @ t_drawn.T + (m.bias[drawn] - self._log_noise[drawn])
        with np.errstate(over="ignore"):
            g_true = 1 / (1 + np.exp(true))
            g_false = -1 / (1 + np.exp(-false))
        g_query = g_true[:, None] * t_word + g_false @ t_drawn
        rows, sums = _add_rows(
            np.concatenate([word, drawn]), np.concatenate([g_true[:, None] * query, g_false.T @ query])
        )
        bias_sums = np.bincount(word, g_true, len(m.bias)) + np.bincount(drawn, g_false.sum(axis=0), len(m.bias))
        context_rows, context_sums = _add_rows(
            np.concatenate([far, near]),
            np.concatenate([m.scales[0] * g_query, m.scales[1] * g_query]),
        )
        scale_sums = np.stack([(g_query * r_far).sum(axis=0), (g_query * r_near).sum(axis=0)])
        self._step(1, rows, sums)
        self._step(2, rows, bias_sums[rows].astype(np.float32))
        self._step(0, context_rows, context_sums)
        self._step(3, np.arange(2), scale_sums)


def train(docs: DataFrame, vocabulary: Vocabulary, shape: Shape) -> LogBilinear:
    """Train on all of ``docs``: in each round, every task learns from its share of the round's
    documents, starting from the last round's model, and the models are averaged by tokens.

    Documents are divided among rounds by a hash of their id, so each is learned from once.
    """
    model = LogBilinear.fresh(shape, vocabulary.class_counts)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.shared())
    for turn in range(shape.rounds):
        start = docs.sparkSession.sparkContext.broadcast(model.flat())

        def run(batches: Iterator[pa.RecordBatch], turn: int = turn, start=start) -> Iterator[pa.RecordBatch]:
            single_thread()
            words = _reader(shared)
            trainer = Trainer(
                LogBilinear.fresh(shape, words.vocabulary.class_counts).like(start.value),
                words.vocabulary.class_counts, shape, turn,
            )
            seen = 0
            for (texts,) in (part for batch in batches for part in texts_of(batch, 256)):
                events = words.events(words.classes(words.codes(byte_words(t))) for t in texts)
                # In an order of its own, so that a step sees many texts.
                trainer.learn(events[np.random.default_rng(seen).permutation(len(events))])
                seen += len(events)
            vector = np.concatenate([trainer.model.flat() * seen, [seen]])
            yield pa.RecordBatch.from_arrays([pa.array([vector.tobytes()], pa.binary())], names=["vector"])

        mine = F.pmod(F.xxhash64("doc_id", F.lit(shape.seed)), F.lit(shape.rounds)) == turn
        vectors = docs.where(mine).select(F.col("text").cast("string")).mapInArrow(run, "vector binary")
        total = tree_sum(vectors, "vector", "f8", len(model.flat()) + 1)
        if total[-1]:
            model = model.like(total[:-1] / total[-1])
    return model


_last: list = []


def _reader(shared) -> Reader:
    """The Python worker's reader of a broadcast vocabulary, made once."""
    value = shared.value
    if not _last or _last[0] is not value:
        _last[:] = [value, Reader(value)]
    return _last[1]


def score_texts(
    docs: DataFrame, held_out: Column, vocabulary: Vocabulary, model: LogBilinear
) -> DataFrame:
    """Parts of each row's scores, and its rare words, whose counts are still to be looked up."""
    context = docs.sparkSession.sparkContext
    shared, flat = context.broadcast(vocabulary.shared()), context.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single_thread()
        words = _reader(shared)
        v = words.vocabulary
        far, near, normal = flat.value.tables()
        log_counts = np.log10(v.counts + 0.1)
        base_log = log10(v.tokens + 0.1 * (v.kinds + 1))
        # Of a class by ending: what its words' counts, and one unseen word's, are divided by.
        class_logs = np.log10(v.class_counts + 0.1 * (v.class_words + 1))
        class_logs[: v.heads] = 0
        class_logs[v.end] = 0
        for columns in (part for batch in batches for part in texts_of(batch)):
            out = {name: [] for name in _SCORED.names}
            for row, doc_id, held, text in zip(*columns):
                tokens = byte_words(text)
                codes = words.codes(tokens)
                classes = words.classes(codes)
                events = words.events([classes])
                u, w, x = events.T
                log_p = (far[u, x] + near[w, x] - normal[u, w]).sum() / np.log(10)
                known = codes >= 0
                by_ending = classes >= v.heads
                counted = log_counts[codes[known & by_ending]].sum() - class_logs[classes[by_ending]].sum()
                n = len(tokens) + 1
                for name, value in zip(_SCORED.names, (
                    row, doc_id, held, n, int(known.sum()) + (v.ends > 0),
                    log_counts[codes[known]].sum() + log10(v.ends + 0.1) - n * base_log,
                    log_p + counted,
                    [tokens[i].decode() for i in np.flatnonzero(~known)],
                )):
                    out[name].append(value)
            yield batch_of(_SCORED, out)

    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), held_out.alias("held_out"),
        F.col("text").cast("string"),
    ).mapInArrow(run, _SCORED_SQL)


def score_documents(docs: DataFrame, modulus: int = 10, shape: Shape = Shape()) -> DataFrame:
    """Score whole texts by a model of those whose crc32(doc_id) is not divisible by ``modulus``.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.
    Words are cut at blanks, A-Z lowered; each text ends with one more token. The base score is the
    add-0.1 unigram one; the score is the model's log10 probability, normalised over all words and
    one unseen word for each class: that of the token's class after the two classes before it,
    times the token's share of its class by counts. NULL and empty texts have the end alone; rows
    that share an id or are equal are scored alike; a corpus without training rows gives scores
    from an untrained model; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    held_out = crc_remainder(F.col("doc_id"), modulus) == 0
    learned = docs.where(~held_out)
    vocabulary = learn_vocabulary(learned, shape)
    model = train(learned, vocabulary, shape)
    rows = stored(score_texts(docs, held_out, vocabulary, model), "scored")
    rare = rows.select("row", F.explode("rare").alias("word"))
    found = rare.join(vocabulary.table, "word", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("logs"), F.count("c").alias("known")
    )
    rest = F.coalesce("logs", F.lit(0.0))
    return rows.drop("rare").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rest).alias("base_score"),
        (F.col("score") + rest).alias("score"),
    )
