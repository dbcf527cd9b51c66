"""A Bloom filter of ids, so that few whole texts have to move for a semi join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Sent
from .words import mix, small_batches

BITS_PER_ID = 16
HASHES = 4
# 16 MB: with more ids than fit, the filter lets more rows pass, and the join that
# follows sorts them out.
MAX_BITS = 1 << 27

_U = np.uint64


def _places(ids: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for seed in range(HASHES):
        at = mix(ids.view(_U), 31 + seed) & _U(bits - 1)
        yield (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63))


def bloom_filter(ids: DataFrame) -> np.ndarray:
    """The filter's words for a stored table of one long column; nulls are left out."""
    needed = min(MAX_BITS, BITS_PER_ID * ids.count())
    bits = 1 << 10
    while bits < needed:
        bits *= 2

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, _U)
        for batch in batches:
            for word, bit in _places(batch.column(0).drop_null().to_numpy(), bits):
                np.bitwise_or.at(words, word, bit)
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(words[some].view(np.int64))], ["word", "bits"]
        )

    gathered = ids.mapInArrow(gather, "word long, bits long")
    table = gathered.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    filled = np.zeros(bits // 64, _U)
    filled[table["word"].to_numpy()] = table["bits"].to_numpy().view(_U)
    return filled


def passes(filled: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit values may be among those of the filter."""
    found = np.ones(len(values), bool)
    for word, bit in _places(values, 64 * len(filled)):
        found &= (filled[word] & bit) != 0
    return found


def maybe_among(rows: DataFrame, ids: DataFrame, key: str = "doc_id", keep: bool = True) -> DataFrame:
    """The rows whose long ``key`` may be one of ``ids``; with ``keep`` False the others.

    No row whose key is among ``ids`` counts as one of the others. ``ids`` is a
    stored table whose one column is ``key``; null keys are among none.
    """
    return _filtered(rows, _sent_filter(ids, key), key, keep)


def parted_by(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Both sides of ``maybe_among``, those that may be among ``ids`` first, by one filter."""
    sent = _sent_filter(ids, key)
    return _filtered(rows, sent, key, True), _filtered(rows, sent, key, False)


def _sent_filter(ids: DataFrame, key: str) -> Sent:
    return Sent(ids.sparkSession, bloom_filter(ids.select(F.col(key).cast("long"))))


def _filtered(rows: DataFrame, sent: Sent, key: str, keep: bool) -> DataFrame:
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = sent.get()
        for batch in small_batches(batches):
            column = batch[key].cast(pa.int64())
            found = np.array(column.is_valid())
            found &= passes(filled, column.fill_null(0).to_numpy())
            yield batch.filter(pa.array(found if keep else ~found))

    return rows.mapInArrow(test, rows.schema)
