"""Toxicity by class-conditional Kneser-Ney models of words as byte sequences.

Each word, in lower case and with marks at both ends, is a sequence of bytes.
Two interpolated Kneser-Ney models, one of toxic and one of ordinary texts, give
its likelihood from the longest context they know down to shorter ones. Both
back off to counts that the classes share, so an expression too rare for either
class is judged alike by both, and a rare form of a known toxic word still
carries the likelihood of its stem.

A text's evidence is the difference of the two log-likelihoods: over the whole
text, divided by its number of words, and over its strongest runs of words,
divided by their length, since a few insults in a long text leave its mean all
but unmoved. A logistic curve over these turns them into a score; it is fitted
on texts whose words the models had not counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Sent
from .words import byte_chunks, find_words, per_batch, small_batches

ORDER = 6
DISCOUNT = 0.75
RUNS = (1, 2, 8)
MAX_LABELLED = 24_000
CALIBRATION_PARTS = 4
THRESHOLD = 0.5

_END = 0x03
_U = np.uint64


def _padded_words(words) -> tuple[np.ndarray, np.ndarray]:
    """All words with an end mark each, in one row, and where each begins."""
    lengths = words.ends - words.starts + 1
    first = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(first[-1]) - np.repeat(first[:-1] - words.starts, lengths)
    data = np.concatenate([words.data, [0]]).astype(np.uint8)[at]
    data[first[1:] - 1] = _END
    return data, first


def _grams(data: np.ndarray, first: np.ndarray, order: int) -> np.ndarray:
    """Per position the last ``order`` bytes as a number; 0x02 stands before a word."""
    key = np.zeros(len(data), _U)
    begin = np.repeat(first[:-1], np.diff(first))
    at = np.arange(len(data))
    for back in range(order - 1, -1, -1):
        from_ = at - back
        byte = np.where(from_ >= begin, data[np.maximum(from_, 0)], 2)
        key = (key << _U(8)) | byte.astype(_U)
    return key


def _unique_words(column: pa.Array) -> Iterator[tuple]:
    """Per chunk: rows, each text's first word, distinct words, their hashes, each word's index."""
    for rows, data, offsets in byte_chunks(column):
        words = find_words(data, offsets)
        hashes = words.hashes()
        distinct, some, which = np.unique(hashes, return_index=True, return_inverse=True)
        chosen = type(words)(words.data, words.offsets, words.starts[some], words.ends[some], None)
        yield rows, words.first, chosen, distinct, which


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct grams of the longest order with their counts by class and part."""
    build = per_batch(["part", "gram", "toxic", "n"], [pa.int32(), pa.int64(), pa.int32(), pa.int64()])
    for batch in batches:
        parts, labels = batch["part"].to_numpy(), batch["label"].to_numpy()
        for rows, first, words, _, which in _unique_words(batch["text"]):
            counts = np.diff(first)
            group = np.repeat(parts[rows] * 2 + labels[rows], counts)
            data, begin = _padded_words(words)
            grams = _grams(data, begin, ORDER)
            lengths = np.diff(begin)
            for g in np.unique(group):
                times = np.bincount(which[group == g], minlength=len(lengths))
                used = np.repeat(times, lengths)
                keys, at = np.unique(grams[used > 0], return_inverse=True)
                n = np.bincount(at, weights=used[used > 0]).astype(np.int64)
                same = np.ones(len(keys), np.int32)
                yield build(same * (g // 2), keys.view(np.int64), same * (g % 2), n)


class Backoff:
    """Both class models over the grams of one set of texts.

    ``levels[k]`` has, for grams of k + 1 bytes in ascending order, their log
    likelihood in the two classes and, for the contexts of that length, the log
    weight of the shorter context.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        """``grams`` ascending, ``counts`` with a column per class."""
        per_level = [(grams, counts.astype(float))]
        for _ in range(ORDER - 1):
            longer, n = per_level[-1]
            mask = _U(2 ** (8 * (ORDER - len(per_level))) - 1)
            keys, at = np.unique(longer & mask, return_inverse=True)
            # A shorter gram counts the distinct bytes that stand before it.
            per_level.append(
                (keys, np.stack([np.bincount(at, weights=n[:, c] > 0) for c in (0, 1)], axis=1))
            )
        per_level.reverse()
        self.levels = []
        lower = None
        for keys, n in per_level:
            contexts, at = np.unique(keys >> _U(8), return_inverse=True)
            total = np.stack([np.bincount(at, weights=n[:, c]) for c in (0, 1)], axis=1)
            kinds = np.stack([np.bincount(at, weights=n[:, c] > 0) for c in (0, 1)], axis=1)
            # Weight of the shorter context; a context that the class never saw passes on whole.
            weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            own = np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1)[at]
            if lower is None:
                both = n.sum(axis=1) / max(n.sum(), 1)
                below = np.repeat((both * 0.99 + 0.01 / 256)[:, None], 2, axis=1)
            else:
                below = self._find(lower, keys & _U(256 ** len(self.levels) - 1))
                # What only one class has seen is smoothed by what both have.
                shared = below.mean(axis=1, keepdims=True)
                below = 0.5 * below + 0.5 * shared
            probability = own + weight[at] * below
            self.levels.append((keys, probability, contexts, weight))
            lower = (keys, probability)

    @staticmethod
    def _find(level, keys: np.ndarray) -> np.ndarray:
        have, values = level[:2]
        at = np.searchsorted(have, keys).clip(0, len(have) - 1)
        return np.where((have[at] == keys)[:, None], values[at], 0.01 / 256)

    def evidence(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per word the log-likelihood as toxic less that as ordinary."""
        if not len(data):
            return np.zeros(0)
        grams = _grams(data, first, ORDER)
        p = np.full((len(grams), 2), 0.01 / 256)
        for k, (keys, values, contexts, weight) in enumerate(self.levels):
            key = grams & _U(2 ** (8 * (k + 1)) - 1)
            at = np.searchsorted(keys, key).clip(0, len(keys) - 1)
            known = keys[at] == key
            c = np.searchsorted(contexts, key >> _U(8)).clip(0, len(contexts) - 1)
            passed = np.where((contexts[c] == key >> _U(8))[:, None], weight[c], 1.0)
            below = 0.5 * p + 0.5 * p.mean(axis=1, keepdims=True) if k else p
            p = np.where(known[:, None], values[at], passed * below)
        ratio = np.log(p[:, 1]) - np.log(p[:, 0])
        return np.add.reduceat(ratio, first[:-1])


class WordMemory:
    """Evidence of the words that a task has met, up to a bound; then it starts anew."""

    def __init__(self, limit: int = 1 << 19) -> None:
        self.limit = limit
        self.hashes, self.values = np.zeros(0, _U), np.zeros(0)

    def evidence(self, model: Backoff, words, distinct: np.ndarray) -> np.ndarray:
        """Evidence of each word, given with its hash in ascending order."""
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        if len(self.hashes):
            known = self.hashes[at.clip(0, len(self.hashes) - 1)] == distinct
        out = np.zeros(len(distinct))
        out[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        picked = type(words)(words.data, words.offsets, words.starts[new], words.ends[new], None)
        out[new] = model.evidence(*_padded_words(picked))
        if len(self.hashes) + len(new) > self.limit:
            self.hashes, self.values = distinct, out
        else:
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.values = np.insert(self.values, at[new], out[new])
        return out


def text_features(model: Backoff, column: pa.Array, memory: WordMemory) -> np.ndarray:
    """Per text: mean evidence, best mean over runs of words, log number of words."""
    out = np.zeros((len(column), 2 + len(RUNS)))
    for rows, first, words, distinct, which in _unique_words(column):
        value = memory.evidence(model, words, distinct)[which]
        sums = np.concatenate([[0.0], np.cumsum(value)])
        counts = np.diff(first)
        block = out[rows]
        block[:, 0] = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(counts, 1)
        for k, run in enumerate(RUNS):
            ahead = np.minimum(np.arange(len(value)) + run, np.repeat(first[1:], counts))
            mean = (sums[ahead] - sums[:-1]) / run
            some = np.flatnonzero(counts)
            if len(some):
                block[some, 1 + k] = np.maximum(np.maximum.reduceat(mean, first[some]), 0)
        block[:, -1] = np.log1p(counts)
    return out


def _fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic curve over few features, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        penalty = ridge * np.concatenate([[0], np.ones(len(w) - 1)])
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (p - y) + penalty * w
        )
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most about ``limit`` training rows ``(doc_id, text, label)``.

    Training rows are those whose crc32 of the id modulo 5 is not 0. Where there
    are more than ``limit``, the bound cuts by a hash of the id, whatever the
    order of rows. Null ids, texts and labels are left out; of a repeated id in
    the label table the greatest label counts.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
        .groupBy("doc_id")
        .agg((F.max(label) > 0).cast("int").alias("label"))
    )
    share = min(1.0, limit / max(known.count(), 1))
    place = F.pmod(F.xxhash64("doc_id", F.lit("labelled")), F.lit(1_000_000))
    known = known.filter(place < int(share * 1_000_000))
    texts = documents.filter("text is not null").select("doc_id", F.col("text").cast("string"))
    # The drawn ids are bounded by ``limit``, so no text moves to find them.
    return texts.join(F.broadcast(known), "doc_id")


class ToxicityModel:
    """The models, the curve over their evidence, and the share of toxic texts."""

    def __init__(self, model: Backoff | None, curve: np.ndarray | None, prior: float) -> None:
        self.model, self.curve, self.prior = model, curve, prior
        self.memory = WordMemory()

    def score(self, column: pa.Array) -> np.ndarray:
        if self.model is None:
            return np.full(len(column), self.prior)
        x = text_features(self.model, column, self.memory)
        score = 1 / (1 + np.exp(-(self.curve[0] + x @ self.curve[1:]).clip(-30, 30)))
        return np.where(x[:, -1] > 0, score, min(self.prior, 0.49))


def fit_toxicity(documents: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> ToxicityModel:
    """Fit on a bounded sample of ``limit`` labelled rows.

    Spark counts the grams of the sample, and all of them enter the counts of the
    shorter contexts; what reaches the driver is bounded by the sample. Without
    labels of both classes every score is the share of toxic labels, or 0 if there
    are none.
    """
    sample = labelled_sample(documents, labels, "toxic", limit)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(CALIBRATION_PARTS)).cast("int")
    sample = sample.select("doc_id", "text", "label", part.alias("part"))
    counts = (
        sample.select("text", "label", "part")
        .mapInArrow(_count_batches, "part int, gram long, toxic int, n long")
        .groupBy("gram")
        .agg(
            *(
                F.sum(F.when((F.col("part") == 0 if p else F.col("part") != 0) & (F.col("toxic") == c), F.col("n")).otherwise(0)).alias(f"n{c}{p}")
                for p in (0, 1)
                for c in (0, 1)
            )
        )
    )
    table = counts.toArrow()
    grams = table["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    n = np.stack([table[f"n{c}{p}"].to_numpy() for p in (0, 1) for c in (0, 1)], axis=1)[order]
    grams = grams[order]
    classes = sample.groupBy("label").count().collect()
    sizes = {r["label"]: r["count"] for r in classes}
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.0
    if len(sizes) < 2 or not len(grams):
        return ToxicityModel(None, None, prior)
    fitting = n[:, :2]
    some = fitting.sum(axis=1) > 0
    first = Sent(documents.sparkSession, Backoff(grams[some], fitting[some]))

    def features(batches):
        model, memory = first.get(), WordMemory()
        for batch in batches:
            x = text_features(model, batch["text"], memory)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[:, i]) for i in range(x.shape[1])] + [batch["label"]],
                [f"x{i}" for i in range(x.shape[1])] + ["label"],
            )

    width = 2 + len(RUNS)
    kind = ", ".join([f"x{i} double" for i in range(width)] + ["label int"])
    held = sample.filter("part = 0").select("text", "label").mapInArrow(features, kind).toArrow()
    if len(set(held["label"].to_pylist())) < 2:
        return ToxicityModel(None, None, prior)
    x = np.stack([held[f"x{i}"].to_numpy() for i in range(width)], axis=1)
    curve = _fit_logistic(x, held["label"].to_numpy().astype(float))
    return ToxicityModel(Backoff(grams, n[:, :2] + n[:, 2:]), curve, prior)


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted.

    ``held_out`` marks ids whose crc32 modulo 5 is 0, from which no label was
    learned (null for a null id). A null or empty text scores the share of toxic
    labels, below one half. Repeated rows score alike; other columns are not
    read. Row by row, no shuffle.
    """
    sent = Sent(documents.sparkSession, model)
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


def drop_toxic(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows whose score is below the threshold, with all their columns."""
    sent = Sent(documents.sparkSession, model)

    def keep(rows):
        fitted = sent.get()
        for batch in small_batches(rows):
            yield batch.filter(pa.array(fitted.score(batch["text"]) < THRESHOLD))

    return documents.mapInArrow(keep, documents.schema)
