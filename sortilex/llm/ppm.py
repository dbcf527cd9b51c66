"""Prediction by partial matching: byte contexts, escapes and symbol exclusion.

The pretrained model is a trie of byte contexts of up to four bytes with the
counts of the symbols (256 bytes and an end) that followed them in the training
texts. A symbol unseen after a context escapes to the next shorter one, with the
weight of the context's distinct symbols (method C); there the symbols of the
longer context are excluded, since an escape has ruled them out.

A text's code length is a sum over its positions of a value that depends on the
last four bytes and the symbol alone. So the trie never has to fit anywhere:
texts are dealt into shares of bounded size, each share lists its distinct
grams, Spark joins them with counts and contexts, and each share gets back the
values of the grams that it holds. The words of the unigram base take the same
way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored
from .words import byte_chunks, find_words, per_batch

ORDER = 4
SYMBOLS = 257
SHARE_BYTES = 16 << 20
MAX_PARTITIONS = 20_000
_END = 256
_SYMBOL_BITS = 9
_CONTEXT_BITS = 8 * ORDER
_COMPACT_AT = 1 << 21
_U = np.uint64


def gram_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One key per symbol, the end of each text included, and where texts begin.

    A key holds the length of the context, its bytes and the symbol.
    """
    first = offsets + np.arange(len(offsets))
    begin, end = first[:-1], first[1:] - 1
    symbols = np.empty(first[-1], np.uint16)
    inner = np.ones(first[-1], bool)
    inner[end] = False
    symbols[inner] = data
    symbols[end] = _END
    context = np.zeros(len(symbols), np.uint32)
    for back in range(ORDER, 0, -1):
        context[back:] |= symbols[:-back].astype(np.uint32) << np.uint32(8 * (back - 1))
    key = context.astype(_U) << _U(_SYMBOL_BITS)
    key |= _U(ORDER << (_CONTEXT_BITS + _SYMBOL_BITS))
    # The first symbols of a text have shorter contexts.
    for known in range(ORDER):
        at = begin[begin + known <= end] + known
        short = (context[at] & np.uint32(256**known - 1)).astype(_U) << _U(_SYMBOL_BITS)
        key[at] = short | _U(known << (_CONTEXT_BITS + _SYMBOL_BITS))
    key |= symbols
    return key.view(np.int64), first


_END_WORD = np.int64(-(2**63) + 1)


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A negative key per word and where texts begin; ends are counted apart."""
    words = find_words(data, offsets)
    return ((words.hashes() >> _U(1)) | _U(1 << 63)).view(np.int64), words.first


class _Tally:
    """Counts by key, merged as they grow; keys stay in ascending order."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, weight: int) -> None:
        """Each key once more; ``weight`` 0 notes the keys without counting them."""
        keys = np.sort(keys)
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        self.keys.append(keys[new])
        self.counts.append(weight * np.diff(np.append(new, len(keys))))
        self.size += len(new)
        if len(self.keys) > 1 and self.size > max(_COMPACT_AT, 3 * len(self.keys[0])):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate(self.counts), minlength=len(keys))
        self.keys, self.counts, self.size = [keys], [counts], len(keys)
        return keys, counts


def _tally_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct keys of each share with their counts in training texts.

    Rows come sorted by share, and a share's keys leave when it ends.
    """
    build = per_batch(["share", "key", "n"], [pa.int32(), pa.int64(), pa.int64()])
    current, tally = None, _Tally()

    def finished() -> Iterator[pa.RecordBatch]:
        keys, counts = tally.merge()
        for at in range(0, len(keys), 100_000):
            part = keys[at : at + 100_000]
            yield build(np.full(len(part), current, np.int32), part, counts[at : at + 100_000].astype(np.int64))

    for batch in batches:
        shares = batch["share"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(shares)) + 1).tolist(), len(shares)]
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            if begin == end:
                continue
            if current is not None and current != shares[begin]:
                yield from finished()
                tally = _Tally()
            current = int(shares[begin])
            run = batch.slice(begin, end - begin)
            learn = run["learn"].to_numpy(zero_copy_only=False)
            for rows, data, offsets in byte_chunks(run["text"]):
                for keys, first in (gram_keys(data, offsets), word_keys(data, offsets)):
                    of = np.repeat(learn[rows], np.diff(first))
                    for weight in np.unique(learn[rows]).tolist():
                        tally.add(keys[of == weight], int(weight))
                for weight, n in zip(*np.unique(learn[rows], return_counts=True), strict=True):
                    tally.add(np.full(n, _END_WORD), int(weight))
    if current is not None:
        yield from finished()


def _shorter(key: Column, level: Column) -> Column:
    """The gram with its context cut to the last ``level`` bytes."""
    symbol = key.bitwiseAND(2**_SYMBOL_BITS - 1)
    context = F.shiftright(key, _SYMBOL_BITS).bitwiseAND(
        F.element_at(F.array(*(F.lit(256**j - 1) for j in range(ORDER + 1))), level + 1)
    )
    tag = level.cast("long") * F.lit(2 ** (_CONTEXT_BITS + _SYMBOL_BITS))
    return tag + context * F.lit(2**_SYMBOL_BITS) + symbol


def _level(key: Column) -> Column:
    return F.shiftright(key, _CONTEXT_BITS + _SYMBOL_BITS).cast("int")


def _context(key: Column) -> Column:
    return F.shiftright(key, _SYMBOL_BITS)


def _all_levels(key: Column) -> Column:
    return F.explode(F.transform(F.sequence(F.lit(0), _level(key)), lambda j: _shorter(key, j)))


def build_trie(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of the trie from rows ``(key, n)`` of training grams.

    First ``(key, c)`` for grams of every level, second per context
    ``(context, total, kinds, below, below_kinds)``: its symbols in all and
    distinct, and what the next shorter context has in counts and distinct
    symbols once these are excluded. Below the empty context all symbols are
    equally likely.
    """
    counts = stored(
        grams.select(_all_levels(F.col("key")).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("c")),
        "trie",
    )
    contexts = counts.groupBy(_context(F.col("key")).alias("context")).agg(
        F.sum("c").alias("total"), F.count("*").alias("kinds")
    )
    longer = counts.filter(_level(F.col("key")) > 0).select(
        _context(F.col("key")).alias("context"),
        _shorter(F.col("key"), _level(F.col("key")) - 1).alias("key"),
    )
    excluded = (
        longer.join(counts, "key")
        .groupBy("context", _context(F.col("key")).alias("parent"))
        .agg(F.sum("c").alias("excluded"))
    )
    parents = contexts.select(
        F.col("context").alias("parent"),
        F.col("total").alias("parent_total"),
        F.col("kinds").alias("parent_kinds"),
    )
    below = excluded.join(parents, "parent").drop("parent")
    left = F.col("parent_kinds") - F.col("kinds")
    joined = contexts.join(below, "context", "left").select(
        "context",
        "total",
        "kinds",
        F.coalesce(F.col("parent_total") - F.col("excluded") + left, SYMBOLS - F.col("kinds")).alias("below"),
        F.coalesce(left, F.lit(0)).alias("below_kinds"),
    )
    return counts, stored(joined, "contexts")


def gram_values(keys: DataFrame, counts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Log10 probability ``value`` of each gram in ``keys``, one row per key.

    A gram that its own context has seen is one ratio. The others list what each
    shorter context knows, at most five rows per gram, and fold the escapes.
    """
    own = keys.join(counts, "key", "left").withColumn("context", _context(F.col("key")))
    seen = (
        own.filter("c is not null")
        .join(contexts, "context")
        .select("key", F.log10(F.col("c") / (F.col("total") + F.col("kinds"))).alias("value"))
    )
    steps = (
        own.filter("c is null")
        .select(F.col("key").alias("gram"), _all_levels(F.col("key")).alias("key"))
        .join(counts, "key", "left")
        .withColumn("context", _context(F.col("key")))
        .join(contexts, "context", "left")
        .filter("total is not null or context = 0")
        .groupBy("gram")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        _level(F.col("key")).alias("level"), "c", "total", "kinds", "below", "below_kinds"
                    )
                ),
                asc=False,
            ).alias("steps")
        )
    )
    # weight: what the level at hand has in all; escape: the part that moves on.
    start = F.struct(
        F.lit(0.0).alias("value"),
        F.lit(None).cast("long").alias("weight"),
        F.lit(None).cast("long").alias("escape"),
        F.lit(False).alias("done"),
    )

    def step(state: Column, at: Column) -> Column:
        weight = F.coalesce(state["weight"], at["total"] + at["kinds"])
        escape = F.coalesce(state["escape"], at["kinds"])
        some = F.when(at["c"].isNotNull(), at["c"]).otherwise(escape)
        gain = F.when(weight > 0, F.log10(some / weight)).otherwise(0.0)
        after = F.struct(
            (state["value"] + gain).alias("value"),
            at["below"].alias("weight"),
            at["below_kinds"].alias("escape"),
            at["c"].isNotNull().alias("done"),
        )
        return F.when(state["done"] | at["total"].isNull(), state).otherwise(after)

    end = F.aggregate(F.col("steps"), start, step)
    unseen = steps.select("gram", end.alias("end")).select(
        F.col("gram").alias("key"),
        F.when(F.col("end.done"), F.col("end.value"))
        .otherwise(F.col("end.value") - F.log10(F.coalesce("end.weight", F.lit(SYMBOLS)).cast("double")))
        .alias("value"),
    )
    return seen.unionByName(unseen)


_RESULT = (
    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()],
)
_RESULT_TYPE = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


class _Values:
    """Values by key, in ascending order of the keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys that are all known. Sorted keys are looked up in one sweep."""
        distinct, at = np.unique(keys, return_inverse=True)
        return self.values[np.searchsorted(self.keys, distinct)][at]


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def score_texts(documents: DataFrame, share_bytes: int = SHARE_BYTES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trains on rows whose crc32 of the id modulo 7 is not 2 and scores all.
    ``score`` is the log10 probability of the bytes and the end of the text;
    ``base_score`` that of its lower-case words and an end under add-one
    unigrams. A null text is empty: one end. A null id is not trained on and has
    a null ``held_out``. Repeated rows count as often as they stand. An empty
    table gives no rows. Other columns are not read. Words are known by 63 bits
    of hash.
    """
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shares = int(size // share_bytes) + 1
    dealt = documents.select(
        F.col("doc_id").cast("long"),
        text.alias("text"),
        held_out.alias("held_out"),
        F.coalesce(~held_out, F.lit(False)).alias("learn"),
    )
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shares)).cast("int")
    dealt = dealt.withColumn("share", share)
    # A share is a partition of its own, up to a bound on partitions.
    width = min(shares, MAX_PARTITIONS)
    by_share = dealt.select("share", "text", "learn").repartitionById(width, F.col("share") % width)
    tallies = stored(
        by_share.sortWithinPartitions("share").mapInArrow(_tally_batches, "share int, key long, n long"),
        "tallies",
    )
    totals = stored(tallies.groupBy("key").agg(F.sum("n").alias("n")), "totals")
    grams, words = totals.filter("key >= 0"), totals.filter("key < 0")
    counts, contexts = build_trie(grams.filter("n > 0"))
    known = words.filter("n > 0").agg(F.sum("n"), F.count("*")).first()
    n_train, n_distinct = int(known[0] or 0), int(known[1])
    values = gram_values(grams.select("key"), counts, contexts).unionByName(
        words.select("key", F.col("n").cast("double").alias("value"))
    )
    given = tallies.select("share", "key").join(values, "key")
    unit = np.log10(n_train + n_distinct + 1)

    def score(texts: pa.Table, table: pa.Table) -> pa.Table:
        build = per_batch(*_RESULT)
        find = _Values(table["key"].to_numpy(), table["value"].to_numpy()).find
        out = []
        for batch in texts.to_batches():
            for rows, data, offsets in byte_chunks(batch["text"]):
                code, first = gram_keys(data, offsets)
                token, begin = word_keys(data, offsets)
                seen, end = find(token), float(find(np.array([_END_WORD]))[0])
                n = len(first) - 1
                base = _per_text(np.log10(seen + 1), begin) + np.log10(end + 1)
                tokens = np.diff(begin) + 1
                some = slice(rows.start, rows.stop)
                out.append(
                    build(
                        batch["doc_id"].slice(some.start, n),
                        batch["held_out"].slice(some.start, n),
                        tokens,
                        (_per_text(seen > 0, begin) + (end > 0)).astype(np.int64),
                        np.full(n, n_train),
                        base - tokens * unit,
                        _per_text(find(code), first),
                    )
                )
        schema = pa.schema(list(zip(*_RESULT, strict=True)))
        return pa.Table.from_batches(out, schema=schema)

    return dealt.groupBy("share").cogroup(given.groupBy("share")).applyInArrow(score, _RESULT_TYPE)
