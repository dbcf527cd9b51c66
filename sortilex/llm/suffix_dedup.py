"""Repeated passages by blockwise suffix sorting with a difference cover.

Every window of 400 bytes is named by its least 32-byte gram (the first of
equals), so equal windows have the same gram at the same place. Neighbouring
windows with one gram form a piece. Pieces of one gram are a bucket of suffixes:
all that can be equal lies in one bucket. Pieces that occur twice as they are
repeat as a whole; only buckets with different pieces have to be sorted, and
only their pieces travel. A bucket too large for a task is divided: windows that hold
the gram at like places share more bytes around it, and those bytes name smaller
buckets.

A task sorts one block of buckets at a time. Suffixes are ordered by their first
64 bytes. Long ties are resolved in constant time each: for any two positions
there is a shift below 64 that brings both into a fixed sample, the difference
cover, whose suffixes were ranked beforehand by doubling. Windows that are equal
then stand side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored
from .words import byte_chunks, mix, per_batch, prefix_hashes, range_hashes

LENGTH = 400
GRAM = 32
GRAMS = LENGTH - GRAM + 1
PERIOD = 64
BLOCK_BYTES = 1 << 20
BUCKET_PIECES = 2_000
WIDTHS = (256, 64, 16, 1)

_U = np.uint64
_PLACE_BITS = 31


def difference_cover(period: int) -> np.ndarray:
    """Residues whose differences reach every residue, chosen greedily."""
    cover, missing = [0], set(range(1, period))
    while missing:
        def gain(c: int) -> int:
            return len({d for x in cover for d in ((c - x) % period, (x - c) % period)} & missing)

        best = max((c for c in range(period) if c not in cover), key=gain)
        missing -= {d for x in cover for d in ((best - x) % period, (x - best) % period)}
        cover.append(best)
    return np.array(sorted(cover))


def _shifts(cover: np.ndarray, period: int) -> np.ndarray:
    """For two residues the least shift that brings both into the cover."""
    inside = np.zeros(period, bool)
    inside[cover] = True
    a, b, d = np.ogrid[:period, :period, :period]
    return (inside[(a + d) % period] & inside[(b + d) % period]).argmax(axis=2)


COVER = difference_cover(PERIOD)
SHIFT = _shifts(COVER, PERIOD)


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """Of texts in a row: text, first window, number of windows, gram and content hash."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < LENGTH:
        return empty, empty, empty, empty.view(_U), empty.view(_U)
    sums = prefix_hashes(data)
    at = np.arange(n - GRAM + 1)
    grams = range_hashes(sums, at, at + GRAM)
    value = (grams >> _U(_PLACE_BITS) << _U(_PLACE_BITS)) | at.astype(_U)
    rows = -(-len(value) // GRAMS)
    padded = np.full(rows * GRAMS, np.iinfo(_U).max, _U)
    padded[: len(value)] = value
    padded = padded.reshape(rows, GRAMS)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n_windows = n - LENGTH + 1
    least = np.minimum(behind[:n_windows], ahead[GRAMS - 1 : GRAMS - 1 + n_windows])
    place = (least & _U(2**_PLACE_BITS - 1)).astype(np.int64)
    text = np.searchsorted(offsets, np.arange(n_windows), "right") - 1
    inside = np.arange(n_windows) + LENGTH <= offsets[text + 1]
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    stop = inside.copy()
    stop[:-1] &= (place[1:] != place[:-1]) | ~inside[1:]
    last = np.flatnonzero(stop)
    content = range_hashes(sums, first, last + LENGTH)
    return text[first], first - offsets[text[first]], last - first + 1, grams[place[first]], content


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    build = per_batch(
        ["key", "doc_id", "start", "windows", "bucket", "content"],
        [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()],
    )
    for batch in batches:
        for rows, data, offsets in byte_chunks(batch["text"]):
            text, start, windows, gram, content = _pieces(data, offsets)
            row = pa.array(text + rows.start)
            yield build(
                batch["key"].take(row),
                batch["doc_id"].take(row),
                start,
                windows,
                gram.view(np.int64),
                content.view(np.int64),
            )


def _as_eights(data: np.ndarray) -> np.ndarray:
    """At each place the eight bytes from there on as a number that sorts like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), _U)
    for j in range(8):
        out = (out << _U(8)) | padded[j : j + len(data)].astype(_U)
    return out


def _refine(groups: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by group and keys, and dense group numbers in that order."""
    order = np.lexsort((*reversed(keys), groups))
    new = np.zeros(len(order), bool)
    for key in (groups, *keys):
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return order, np.cumsum(new)


def _tied(groups: np.ndarray) -> np.ndarray:
    """Which of the ascending group numbers occur more than once."""
    same = np.zeros(len(groups) + 1, bool)
    same[1:-1] = groups[1:] == groups[:-1]
    return same[1:] | same[:-1]


def cover_ranks(data: np.ndarray, eights: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of the sampled suffixes, each up to its piece's end; -1 elsewhere.

    ``ends`` has the end of the piece at each place. First by up to 64 bytes,
    then by doubling: the sample repeats every 64 bytes, so a sampled suffix
    goes on with another one.
    """
    inside = np.zeros(PERIOD, bool)
    inside[COVER] = True
    at = np.flatnonzero(inside[np.arange(len(data)) % PERIOD])
    left = np.minimum(ends[at] - at, PERIOD)
    keys = []
    for k in range(0, PERIOD, 8):
        have = np.clip(left - k, 0, 8)
        # Bytes beyond the end count as zero; the length left tells them apart.
        shift = (64 - 8 * have).astype(_U)
        word = eights[np.minimum(at + k, len(eights) - 1)]
        keys.append(np.where(have > 0, word >> np.minimum(shift, _U(63)) << np.minimum(shift, _U(63)), _U(0)))
    order, group = _refine(np.zeros(len(at), np.int64), *keys, left)
    ranks = np.full(len(data), -1, np.int64)
    ranks[at[order]] = group
    step = PERIOD
    while step < int((ends[at] - at).max(initial=0)) and _tied(group).any():
        next_ = at + step
        onward = np.where(next_ < ends[at], ranks[np.minimum(next_, len(data) - 1)], -1)
        order, group = _refine(ranks[at], onward)
        ranks[at[order]] = group
        step *= 2
    return ranks


def repeated_windows(data: np.ndarray, first: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Which windows of the pieces of one block occur twice or more in their bucket.

    ``first`` has where each piece begins, and the end. Returns a flag per place
    of ``data``; only the beginnings of windows can be set.
    """
    lengths = np.diff(first)
    piece = np.repeat(np.arange(len(lengths)), lengths)
    ends = first[1:][piece]
    flags = np.zeros(len(data), bool)
    eights = _as_eights(data)
    at = np.flatnonzero(np.arange(len(data)) + LENGTH <= ends)
    group = np.unique(buckets, return_inverse=True)[1][piece[at]]
    for k in range(0, PERIOD, 8):
        order, group = _refine(group, eights[at + k])
        some = _tied(group)
        at, group = at[order][some], group[some]
        if not len(at):
            return flags
    ranks = cover_ranks(data, eights, ends)
    # Quicksort all groups of ties at once, each by a pivot of its own. A group is
    # a stretch of ``at``; only members that are not yet in place move.
    new = np.concatenate([[True], group[1:] != group[:-1]])
    moving = np.ones(len(at), bool)
    while moving.any():
        some = np.flatnonzero(moving)
        own, number = at[some], np.cumsum(new)[some]
        begin = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        size = np.diff(np.append(begin, len(number)))
        pivot = np.repeat(own[begin + size // 2], size)
        shift = SHIFT[own % PERIOD, pivot % PERIOD]
        side = np.sign(ranks[own + shift] - ranks[pivot + shift])
        order = np.lexsort((side, number))
        at[some], side = own[order], side[order]
        new[some[1:]] |= side[1:] != side[:-1]
        moving[some] = (side != 0) & _tied(np.cumsum(new)[some])
    pair = np.flatnonzero(group[1:] == group[:-1])
    for k in range(PERIOD, LENGTH, 8):
        pair = pair[eights[at[pair] + k] == eights[at[pair + 1] + k]]
    flags[at[pair]] = flags[at[pair + 1]] = True
    return flags


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [{"begin": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


_SPANS = "array<struct<begin: bigint, end: bigint>>"
_SPANS_ARROW = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _sort_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts blocks of whole buckets; rows come ordered by bucket."""
    build = per_batch(["bucket", "content", "spans"], [pa.int64(), pa.int64(), _SPANS_ARROW])

    def done(block: list[dict]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r["piece"] for r in block), np.uint8)
        first = np.concatenate([[0], np.cumsum([len(r["piece"]) for r in block])])
        flags = repeated_windows(data, first, np.array([r["bucket"] for r in block]))
        spans = [_runs(flags[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        keep = [i for i, s in enumerate(spans) if s and not block[i]["twice"]]
        return build(
            [block[i]["bucket"] for i in keep],
            [block[i]["content"] for i in keep],
            [spans[i] for i in keep],
        )

    block, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            if size >= BLOCK_BYTES and row["bucket"] != block[-1]["bucket"]:
                yield done(block)
                block, size = [], 0
            block.append(row)
            size += len(row["piece"])
    if block:
        yield done(block)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the pieces that are asked for, text by text."""
    build = per_batch(
        ["bucket", "content", "twice", "hot", "piece"],
        [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()],
    )
    for batch in batches:
        for text, wanted in zip(batch["text"], batch["wanted"], strict=True):
            data, wanted = text.as_py().encode(), wanted.as_py()
            yield build(
                [w["bucket"] for w in wanted],
                [w["content"] for w in wanted],
                [w["twice"] for w in wanted],
                [w["hot"] for w in wanted],
                [data[w["start"] : w["start"] + w["windows"] + LENGTH - 1] for w in wanted],
            )


def _gram_place(data: np.ndarray, bucket: int) -> int:
    """Where the gram of a piece's bucket first stands in the piece."""
    at = np.arange(GRAMS)
    grams = range_hashes(prefix_hashes(data), at, at + GRAM).view(np.int64)
    return int((grams == bucket).argmax())


_PART_COLUMNS = (
    "bucket long, content long, twice boolean, at long, windows long, "
    "part long, same long, gram long, piece binary"
)


def _split_batches(width: int):
    """Cuts pieces where their windows hold the gram at another multiple of ``width``.

    Windows of a part hold their gram at one of ``width`` places, so all of them
    share ``LENGTH - width + 1`` bytes around it, which name the part's bucket.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, flag = pa.int64(), pa.bool_()
        build = per_batch(
            ["bucket", "content", "twice", "at", "windows", "part", "same", "gram", "piece"],
            [whole, whole, flag, whole, whole, whole, whole, whole, pa.binary()],
        )
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["piece"], np.uint8)
                gram = row["gram"]
                if gram is None:
                    gram = _gram_place(data, row["bucket"])
                slot = (gram - np.arange(len(data) - LENGTH + 1)) // width
                at = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
                windows = np.diff(np.append(at, len(slot)))
                sums = prefix_hashes(data)
                low = slot[at] * width
                # Relative to the gram, from the last window's begin to the first one's end.
                shared = np.full(len(at), np.uint64(row["bucket"] % 2**64))
                shared ^= range_hashes(sums, gram - low, gram - low - width + 1 + LENGTH)
                part = mix(shared + mix(low.astype(_U), 41), 42)
                stop = at + windows + LENGTH - 1
                yield build(
                    *(np.full(len(at), row[c]) for c in ("bucket", "content", "twice")),
                    at,
                    windows,
                    part.view(np.int64),
                    range_hashes(sums, at, stop).view(np.int64),
                    gram - at,
                    [row["piece"][a:b] if width > 1 else None for a, b in zip(at, stop, strict=True)],
                )

    return split


def _sorted_blocks(pieces: DataFrame) -> DataFrame:
    """Repeated windows of pieces whose buckets fit in a task each."""
    return (
        pieces.select("bucket", "content", "twice", "piece")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_sort_batches, f"bucket long, content long, spans {_SPANS}")
    )


def _whole(windows: str) -> Column:
    span = F.struct(F.lit(0).cast("long").alias("begin"), F.col(windows).cast("long").alias("end"))
    return F.array(span).alias("spans")


def _divided(pieces: DataFrame, bucket_pieces: int, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Repeated windows of buckets too large for one task, from smaller buckets.

    The pieces are cut into parts, and a part's bucket shares more than the gram.
    Equal parts are settled by their number, buckets of different parts are
    sorted, and those that are still too large are divided again. At a width of
    one a part is a window and all of its bucket are equal, so this comes to an end.
    """
    width, *rest = widths
    # A fixed number of tasks: by its bytes alone, little data would go to one.
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.repartition(tasks, "bucket", "content").distinct()
    parts = stored(pieces.mapInArrow(_split_batches(width), _PART_COLUMNS), "parts")
    alike = parts.groupBy("part", "same").agg(
        ((F.count("*") > 1) | F.max("twice")).alias("twice"),
        F.first("windows").alias("windows"),
        F.first("gram").alias("gram"),
        F.first("piece").alias("piece"),
    )
    alike = stored(alike.withColumnsRenamed({"part": "bucket", "same": "content"}), "alike")
    found = alike.filter("twice").select("bucket", "content", _whole("windows"))
    if rest:
        sizes = alike.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
        mixed = stored(alike.join(sizes, "bucket"), "divided")
        large = F.col("size") > bucket_pieces
        found = found.unionByName(_sorted_blocks(mixed.filter(~large)))
        hot = mixed.filter(large).select("bucket", "content", "twice", "gram", "piece")
        if not hot.isEmpty():
            found = found.unionByName(_divided(hot, bucket_pieces, tuple(rest)))
    found = stored(found, "found").withColumnsRenamed({"bucket": "part", "content": "same"})
    span = F.struct(
        (F.col("at") + F.col("span.begin")).alias("begin"), (F.col("at") + F.col("span.end")).alias("end")
    )
    return (
        parts.filter("not twice")
        .select("bucket", "content", "at", "part", "same")
        .join(found, ["part", "same"])
        .select("bucket", "content", "at", F.explode("spans").alias("span"))
        .groupBy("bucket", "content")
        .agg(F.collect_set(span).alias("spans"))
    )


def repeated_spans(documents: DataFrame, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """Rows ``(key, doc_id, spans)`` of texts that hold a repeated passage.

    ``spans`` lists runs of windows by the places where they begin and end, to
    which a window's length is already added: ``begin`` to ``end`` in bytes, in
    any order, overlapping. ``documents`` has ``key``, ``doc_id`` and ``text``.
    """
    pieces = stored(
        documents.mapInArrow(
            _piece_batches,
            "key long, doc_id long, start long, windows long, bucket long, content long",
        ),
        "pieces",
    )
    place = F.struct("key", "doc_id", "start", "windows")
    contents = pieces.groupBy("bucket", "content").agg(
        F.count("*").alias("n"), F.min(place).alias("place")
    )
    mixed = (
        pieces.groupBy("bucket")
        .agg(F.min("content").alias("low"), F.max("content").alias("high"))
        .filter("low < high")
        .select("bucket")
    )
    contents = stored(
        contents.join(mixed.withColumn("mixed", F.lit(True)), "bucket", "left").filter("n > 1 or mixed"),
        "contents",
    )
    sizes = contents.filter("mixed").groupBy("bucket").agg(F.count("*").alias("size"))
    asked = (
        contents.filter("mixed")
        .join(sizes, "bucket")
        .select(
            "place.key",
            "place.doc_id",
            F.struct(
                "place.start",
                "place.windows",
                "bucket",
                "content",
                (F.col("n") > 1).alias("twice"),
                (F.col("size") > bucket_pieces).alias("hot"),
            ).alias("w"),
        )
        .groupBy("key", "doc_id")
        .agg(F.collect_list("w").alias("wanted"))
    )
    # One row stands for rows that repeat an id with its text.
    texts = asked.withColumnRenamed("doc_id", "asked_id").join(documents, "key")
    texts = texts.filter(F.col("asked_id").eqNullSafe(F.col("doc_id"))).select("text", "wanted")
    cut = stored(
        texts.mapInArrow(
            _cut_batches, "bucket long, content long, twice boolean, hot boolean, piece binary"
        ),
        "cut",
    )
    sorted_ = _sorted_blocks(cut.filter("not hot").distinct())
    hot = cut.filter("hot").select("bucket", "content", "twice", "piece")
    whole = contents.filter("n > 1").select("bucket", "content", _whole("place.windows"))
    repeated = whole.unionByName(sorted_)
    if not hot.isEmpty():
        hot = hot.withColumn("gram", F.lit(None).cast("long"))
        repeated = repeated.unionByName(_divided(hot, bucket_pieces))
    repeated = stored(repeated, "repeated")
    at = F.struct(
        (F.col("start") + F.col("span.begin")).alias("begin"),
        (F.col("start") + F.col("span.end") + (LENGTH - 1)).alias("end"),
    )
    return (
        pieces.join(repeated, ["bucket", "content"])
        .select("key", "doc_id", "start", F.explode("spans").alias("span"))
        .groupBy("key", "doc_id")
        .agg(F.collect_set(at).alias("spans"))
    )


def _keep_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    build = per_batch(
        ["doc_id", "n_bytes", "kept", "spans"],
        [pa.int64(), pa.int64(), pa.binary(), _SPANS_ARROW],
    )
    for batch in batches:
        kept, spans, sizes = [], [], []
        for text, found in zip(batch["text"], batch["spans"], strict=True):
            data = text.as_py().encode()
            flags = np.zeros(len(data) + 1, np.int64)
            for span in found.as_py() or ():
                flags[span["begin"]] += 1
                flags[span["end"]] -= 1
            gone = np.cumsum(flags)[: len(data)] > 0
            sizes.append(len(data))
            kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
            spans.append(_runs(gone))
        yield build(batch["doc_id"], sizes, kept, spans)


def remove_repeats(documents: DataFrame, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """Per row: doc_id, n_bytes, ``kept`` (bytes) and ``spans`` (removed runs).

    A byte goes if a 400-byte string over it begins anywhere else too, in the
    same text or another; matches do not cross texts and are judged on the
    input. A null text counts as empty; texts under 400 bytes stay whole. Rows
    that repeat a doc_id count as texts of their own. A null doc_id is kept as
    such. An empty table gives no rows; other columns are not read.

    Buckets of more than ``bucket_pieces`` different pieces are divided by more
    of the bytes that their windows share, until each fits in a task; see
    ``_divided``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    spans = repeated_spans(rows, bucket_pieces)
    spans = spans.select("key", F.col("doc_id").alias("span_id"), "spans")
    same: Column = (rows.key == spans.key) & rows.doc_id.eqNullSafe(spans.span_id)
    return (
        rows.join(spans, same, "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_keep_batches, f"doc_id long, n_bytes long, kept binary, spans {_SPANS}")
    )
