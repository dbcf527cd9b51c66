"""A factorisation machine that scores the quality of texts.

Inputs are hashed words, and structure statistics and metadata of the text in
bins. Each has a weight and a short vector; a pair of inputs adds the product of
its vectors, so that a sign that is harmless in one setting can count in another.
All pairs together cost no more than the inputs: the sum over pairs is half of
the squared sum less the sum of squares, per dimension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Sent
from .toxicity import labelled_sample
from .words import byte_chunks, find_words, per_batch, prefix_hashes, range_hashes

HASHED = 1 << 12
BINS = 16
RANK = 8
EPOCHS = 6
BATCH = 256
MAX_LABELLED = 24_000
THRESHOLD = 0.3
SEED = 7

STATS = (
    "log_bytes",
    "log_words",
    "log_lines",
    "word_bytes",
    "upper",
    "digits",
    "signs",
    "bars",
    "exclaims",
    "high_bytes",
    "distinct_words",
    "repeats_next",
    "distinct_pairs",
    "distinct_lines",
)
_SIGNS = np.zeros(256, bool)
_SIGNS[[ord(c) for c in "#*$%&<>@=_~^{}[]"]] = True
_U = np.uint64


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[first[1:]] - total[first[:-1]]).astype(float)


def _distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each text, in text order: values, counts, and where texts begin."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, text))
    v, t = values[order], text[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.concatenate([at, [len(v)]]))
    return v[at], counts, np.searchsorted(t[at], np.arange(len(first)))


def describe(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: rows, statistics per text, hashed words per text, where texts begin."""
    for rows, data, offsets in byte_chunks(column):
        words = find_words(data, offsets, lower=False)
        hashes = words.hashes()
        n, size = words.counts.astype(float), np.diff(offsets).astype(float)
        some_n, some_size = np.maximum(n, 1), np.maximum(size, 1)
        share = lambda flags, of=some_size, at=offsets: _sums(flags, at) / of
        slots, counts, begin = _distinct(hashes, words.first)
        follows = np.zeros(len(hashes), bool)
        follows[1:] = hashes[1:] == hashes[:-1]
        follows[words.first[:-1][n > 0]] = False
        pairs = hashes.copy()
        pairs[1:] = hashes[1:] * _U(3) + hashes[:-1]
        _, _, pair_begin = _distinct(pairs, words.first)
        newline = np.flatnonzero(data == 10)
        edges = np.union1d(np.union1d(newline + 1, offsets), newline)
        starts, ends = edges[:-1], edges[1:]
        full = (ends > starts) & (data[starts] != 10) if len(starts) else np.zeros(0, bool)
        starts, ends = starts[full], ends[full]
        line_first = np.searchsorted(starts, offsets)
        lines = np.diff(line_first).astype(float)
        _, _, line_begin = _distinct(range_hashes(prefix_hashes(data), starts, ends), line_first)
        stats = np.column_stack(
            [
                np.log1p(size),
                np.log1p(n),
                np.log1p(lines),
                size / some_n,
                share((data >= 65) & (data <= 90)),
                share((data >= 48) & (data <= 57)),
                share(_SIGNS[data]),
                share(data == ord("|")),
                share(data == ord("!")),
                share(data >= 128),
                np.diff(begin) / some_n,
                share(follows, some_n, words.first),
                np.diff(pair_begin) / some_n,
                np.diff(line_begin) / np.maximum(lines, 1),
            ]
        )
        inputs = (slots >> _U(52)).astype(np.int64) % HASHED
        yield rows, stats, inputs, begin


def _feature_batches(batches):
    build = per_batch(
        ["stats", "inputs", "label"],
        [pa.list_(pa.float64()), pa.list_(pa.int32()), pa.int32()],
    )
    for batch in batches:
        for rows, stats, inputs, begin in describe(batch["text"]):
            yield build(
                list(stats),
                [np.unique(inputs[a:b]).astype(np.int32) for a, b in zip(begin[:-1], begin[1:], strict=True)],
                batch["label"].slice(rows.start, rows.stop - rows.start),
            )


class FactorisationMachine:
    """Weights and vectors of hashed words, then of every bin of every statistic."""

    def __init__(self, edges: np.ndarray, prior: float) -> None:
        rng = np.random.default_rng(SEED)
        self.edges = edges
        size = HASHED + len(STATS) * (BINS + 1)
        self.bias = float(np.log((prior + 1e-3) / (1 - prior + 1e-3)))
        self.weights = np.zeros(size)
        self.vectors = rng.normal(0, 0.05, (size, RANK))

    def bins(self, stats: np.ndarray) -> np.ndarray:
        """The input number of each statistic of each text."""
        place = [np.searchsorted(e, stats[:, i], "right") for i, e in enumerate(self.edges)]
        return HASHED + np.stack(place, axis=1) + np.arange(len(STATS)) * (BINS + 1)

    def dense(self, stats: np.ndarray, inputs: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(stats), len(self.weights)))
        for row, slots in enumerate(inputs):
            x[row, slots] = 1 / np.sqrt(max(len(slots), 1))
        np.put_along_axis(x, self.bins(stats), 1.0, axis=1)
        return x

    def fit(self, stats: np.ndarray, inputs: list[np.ndarray], y: np.ndarray) -> None:
        """Logistic loss by AdaGrad over shuffled batches."""
        rng = np.random.default_rng(SEED)
        rate, penalty = 0.1, 1e-4
        met = np.zeros(len(self.weights), bool)
        met[np.unique(np.concatenate([*inputs, self.bins(stats).ravel()]))] = True
        seen_w, seen_v, seen_b = np.full_like(self.weights, 1e-6), np.full_like(self.vectors, 1e-6), 1e-6
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for at in range(0, len(y), BATCH):
                rows = order[at : at + BATCH]
                x = self.dense(stats[rows], [inputs[i] for i in rows])
                sums, squares = x @ self.vectors, x * x
                z = self.bias + x @ self.weights
                z += 0.5 * (sums**2 - squares @ self.vectors**2).sum(axis=1)
                g = (1 / (1 + np.exp(-z.clip(-30, 30))) - y[rows]) / len(rows)
                grad_w = x.T @ g + penalty * self.weights
                grad_v = x.T @ (g[:, None] * sums) - self.vectors * (squares.T @ g)[:, None]
                grad_v += penalty * self.vectors
                seen_w += grad_w**2
                seen_v += grad_v**2
                seen_b += g.sum() ** 2
                self.weights -= rate * grad_w / np.sqrt(seen_w)
                self.vectors -= rate * grad_v / np.sqrt(seen_v)
                self.bias -= rate * g.sum() / np.sqrt(seen_b)
        # What no training row had still holds its random start.
        self.vectors[~met] = 0

    def score(self, column: pa.Array) -> np.ndarray:
        """Per text the probability of good quality, in time linear in its inputs."""
        out = np.zeros(len(column))
        for rows, stats, inputs, begin in describe(column):
            text = np.repeat(np.arange(len(stats)), np.diff(begin))
            # A slot counts once per text, however many words share it.
            flat = np.unique(text * HASHED + inputs)
            text, slot = flat // HASHED, flat % HASHED
            first = np.searchsorted(text, np.arange(len(stats) + 1))
            value = 1 / np.sqrt(np.maximum(np.diff(first), 1))
            per_text = lambda a: np.diff(
                np.concatenate([np.zeros((1, a.shape[1])), np.cumsum(a, axis=0)])[first], axis=0
            )
            both = per_text(np.column_stack([self.vectors[slot], self.vectors[slot] ** 2, self.weights[slot]]))
            bins = self.bins(stats)
            sums = both[:, :RANK] * value[:, None] + self.vectors[bins].sum(axis=1)
            squares = both[:, RANK:-1] * (value**2)[:, None] + (self.vectors[bins] ** 2).sum(axis=1)
            linear = both[:, -1] * value + self.weights[bins].sum(axis=1)
            z = self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)
            out[rows] = 1 / (1 + np.exp(-z.clip(-30, 30)))
        return out


def fit_quality(documents: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> FactorisationMachine:
    """Fit on a bounded sample of ``limit`` labelled rows.

    Tasks turn texts into inputs, so what reaches the driver is at most ``limit``
    rows of at most 4,096 small numbers. Without any label every text scores one half.
    """
    sample = labelled_sample(documents, labels, "quality", limit)
    kind = "stats array<double>, inputs array<int>, label int"
    table = (
        sample.select("text", "label").mapInArrow(_feature_batches, kind).toArrow().combine_chunks()
    )
    if not len(table):
        machine = FactorisationMachine(np.zeros((len(STATS), BINS)), 0.5)
        machine.vectors[:] = 0
        return machine
    stats = np.array(table["stats"].to_pylist())
    inputs = [np.array(x, np.int64) for x in table["inputs"].to_pylist()]
    y = table["label"].to_numpy().astype(float)
    # Rows arrive in any order; a fixed one makes reruns agree.
    order = np.lexsort((*stats.T, y))
    stats, inputs, y = stats[order], [inputs[i] for i in order], y[order]
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 2)[1:-1], axis=0).T
    machine = FactorisationMachine(edges, float(y.mean()))
    machine.fit(stats, inputs, y)
    return machine


def score_quality(documents: DataFrame, machine: FactorisationMachine) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted.

    ``held_out`` marks ids whose crc32 modulo 5 is 0, from which no label was
    learned (null for a null id). A null text counts as empty; an empty text is
    scored like any other, from its statistics. Repeated rows score alike; other
    columns are not read. Row by row, no shuffle.
    """
    sent = Sent(documents.sparkSession, machine)
    build = per_batch(["doc_id", "score"], [pa.int64(), pa.float64()])

    def batches(rows):
        fitted = sent.get()
        for batch in rows:
            yield build(batch["doc_id"], fitted.score(batch["text"]))

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "doc_id long, score double").select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
