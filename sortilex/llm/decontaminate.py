"""Benchmark decontamination by SimHash of item-sized windows.

A window has as many words as a benchmark item. Its SimHash has 128 bits, each
the sign of the sum of one bit over its five-word shingles, so windows like an
item differ from it in few bits. The fingerprints of the items are indexed in 16
blocks of 8 bits: within a distance of 40, some block differs in at most two
bits, and the index lists for every block value the items within two bits of it,
so no item within the radius is missed. At a weighted similarity of 0.8 the
distance is 19 on average with a deviation of 4; 40 lies five deviations off.
The weighted similarity of shingles, each weighing as often as it occurs,
decides about every candidate.

A window without a shingle of any item has no similarity to one, and one with
too few of them cannot reach the threshold, so only the others are
fingerprinted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .id_filter import bloom_filter, parted_by, passes
from .store import Sent, free_name, stored
from .words import SHINGLE_WORDS, byte_chunks, find_words, mix, shingle_hashes, small_batches

BITS = 128
BLOCKS = 16
RADIUS = 40
SIMILARITY = 0.8
ITEMS_AT_ONCE = 2_048
# Of the items' texts; their index takes some 20 times as much.
INDEXED_BYTES = 1 << 20
# Of the texts that one task compares with a block of items.
GROUP_BYTES = 16 << 20
SHINGLE_SALTS = 16

_NEAR = RADIUS // BLOCKS
_ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)
_U = np.uint64


def _signs(hashes: np.ndarray) -> np.ndarray:
    """Per shingle its 128 random signs."""
    both = np.stack([mix(hashes, 31), mix(hashes, 32)], axis=1)
    bits = np.unpackbits(both.astype(">u8").view(np.uint8).reshape(len(hashes), BITS // 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """SimHash of each row of summed signs, as 16 bytes."""
    return np.packbits(sums > 0, axis=1)


def weighted_similarity(a: Counter, b: Counter) -> float:
    common = sum((a & b).values())
    every = sum((a | b).values())
    return common / every if every else 0.0


class ItemIndex:
    """Up to ``ITEMS_AT_ONCE`` benchmark items, by shingle and by fingerprint block."""

    def __init__(self, ids: list, texts: list) -> None:
        hashes, counts = [], []
        for _, data, offsets in byte_chunks(pa.array(texts, pa.large_string())):
            words = find_words(data, offsets)
            runs, first = shingle_hashes(words.hashes(), words.first)
            hashes += [runs[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
            counts += list(words.counts)
        usable = [i for i, n in enumerate(counts) if n]
        self.ids = [ids[i] for i in usable]
        self.words = np.array([counts[i] for i in usable], np.int64)
        self.counters = [Counter(hashes[i].tolist()) for i in usable]
        runs = [hashes[i] for i in usable]
        owner = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        every = np.concatenate(runs) if runs else np.zeros(0, _U)
        pairs = np.unique(np.stack([every, owner.astype(_U)], axis=1), axis=0)
        self.keys, begin = np.unique(pairs[:, 0], return_index=True)
        self.begin = np.append(begin, len(pairs))
        self.owners = pairs[:, 1].astype(np.int64)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.keys >> _U(48)).astype(np.int64)] = True
        sums = [_signs(r).sum(axis=0, dtype=np.int64) for r in runs]
        self.prints = fingerprints(np.array(sums).reshape(-1, BITS))
        # For each block and value, a bit per item within two bits of it.
        distance = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]]
        self.table = np.stack(
            [np.packbits(distance[:, self.prints[:, b]] <= _NEAR, axis=1) for b in range(BLOCKS)]
        )

    def candidates(self, windows: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and item numbers within the radius, among the items ``of``."""
        near = self.table[0][windows[:, 0]]
        for b in range(1, BLOCKS):
            near = near | self.table[b][windows[:, b]]
        listed = np.unpackbits(near, axis=1, count=len(self.ids)).astype(bool)
        only = np.zeros(len(self.ids), bool)
        only[of] = True
        w, i = np.nonzero(listed & only)
        close = _ONES[windows[w] ^ self.prints[i]].sum(axis=1) <= RADIUS
        return w[close], i[close]

    def _hits(self, runs: np.ndarray) -> np.ndarray:
        """Which shingles belong to an item."""
        hit = np.zeros(len(runs), bool)
        if len(self.keys):
            maybe = np.flatnonzero(self.seen[(runs >> _U(48)).astype(np.int64)])
            at = np.searchsorted(self.keys, runs[maybe]).clip(0, len(self.keys) - 1)
            hit[maybe] = self.keys[at] == runs[maybe]
        return hit

    def _items(self, runs: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, np.unique(runs))
        return np.unique(np.concatenate([self.owners[self.begin[k] : self.begin[k + 1]] for k in at]))

    def _text_matches(self, runs: np.ndarray, hit: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """The best window of each matching item: similarity, first word, words."""
        best: dict[int, tuple[float, int, int]] = {}
        items = self._items(runs[hit])
        items = items[self.words[items] >= SHINGLE_WORDS]
        total = np.concatenate([[0], np.cumsum(hit)])
        # Signs only where some window can hold a hit.
        reach = int(self.words[items].max()) if len(items) else 0
        spots = np.flatnonzero(hit)
        low, high = max(0, spots[0] - reach), min(len(runs), spots[-1] + reach)
        sums = np.zeros((high - low + 1, BITS), np.int32)
        np.cumsum(_signs(runs[low:high]), axis=0, out=sums[1:])
        for n_words in np.unique(self.words[items]):
            size = int(n_words) - SHINGLE_WORDS + 1
            width = min(size, len(runs))
            least = SIMILARITY / (1 + SIMILARITY) * (width + size) - 1e-9
            starts = np.flatnonzero(total[width:] - total[:-width] >= least)
            starts = starts[(starts >= low) & (starts + width <= high)]
            for at in range(0, len(starts), 4096):
                some = starts[at : at + 4096]
                windows = fingerprints(sums[some - low + width] - sums[some - low])
                found = self.candidates(windows, items[self.words[items] == n_words])
                for w, i in zip(*(x.tolist() for x in found), strict=True):
                    start = int(some[w])
                    window = Counter(runs[start : start + width].tolist())
                    value = weighted_similarity(window, self.counters[i])
                    if value >= SIMILARITY and (i not in best or value > best[i][0]):
                        best[i] = (value, start, width + SHINGLE_WORDS - 1)
        return best

    def matches(self, column: pa.Array) -> Iterator[tuple[int, int, float, int, int]]:
        """Row, item, similarity, first word and number of words of each match."""
        short = [int(n) for n in np.unique(self.words) if n < SHINGLE_WORDS]
        for rows, data, offsets in byte_chunks(column):
            words = find_words(data, offsets)
            hashes = words.hashes()
            for size in [*short, SHINGLE_WORDS]:
                runs, first = shingle_hashes(hashes, words.first, size)
                hit = self._hits(runs)
                for row in np.unique(np.searchsorted(first, np.flatnonzero(hit), "right") - 1):
                    own, marks = runs[first[row] : first[row + 1]], hit[first[row] : first[row + 1]]
                    if words.counts[row] < size:
                        continue
                    if size == SHINGLE_WORDS:
                        found = self._text_matches(own, marks)
                    else:  # an item of so few words is one shingle: equal or not
                        found = {}
                        for start in np.flatnonzero(marks)[::-1]:
                            for i in self._items(own[start : start + 1]):
                                if self.words[i] == size:
                                    found[int(i)] = (1.0, int(start), size)
                    for i, (value, start, n) in sorted(found.items()):
                        yield rows.start + int(row), i, value, start, n


def _items(benchmark: DataFrame) -> DataFrame:
    """Each different text of the benchmark once, with its digest, stored."""
    texts = benchmark.filter("text is not null").select(F.col("text").cast("string").alias("text"))
    return stored(texts.distinct().select(F.sha2("text", 256).alias("item"), "text"), "items")


def _sent_index(items: DataFrame) -> Sent | None:
    """The index of all items for every task, or None if they are too many or too long."""
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if size["n"] > ITEMS_AT_ONCE or (size["bytes"] or 0) > INDEXED_BYTES:
        return None
    rows = items.orderBy("item").collect()
    return Sent(items.sparkSession, ItemIndex([r["item"] for r in rows], [r["text"] for r in rows]))


_MATCH = "item string, similarity double, first_word long, n_words long"


def _match_columns(index: ItemIndex, got: list[tuple[int, int, float, int, int]]) -> list[pa.Array]:
    return [
        pa.array([index.ids[g[1]] for g in got], pa.string()),
        pa.array([g[2] for g in got], pa.float64()),
        pa.array([g[3] for g in got], pa.int64()),
        pa.array([g[4] for g in got], pa.int64()),
    ]


def _hashed_items(items: DataFrame) -> DataFrame:
    """The items dealt to blocks, with their numbers of words and different shingles; stored."""
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size["n"] // ITEMS_AT_ONCE), -(-size["bytes"] // INDEXED_BYTES))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n_words, shingles = [], []
            for _, data, offsets in byte_chunks(batch["text"]):
                words = find_words(data, offsets)
                runs, first = shingle_hashes(words.hashes(), words.first)
                n_words += words.counts.tolist()
                for a, b in zip(first[:-1], first[1:], strict=True):
                    shingles.append(np.unique(runs[a:b]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["item"],
                    batch["text"],
                    pa.array(n_words, pa.int64()),
                    pa.array(shingles, pa.list_(pa.int64())),
                ],
                ["item", "text", "n_words", "shingles"],
            )

    rows = items.mapInArrow(hashed, "item string, text string, n_words long, shingles array<long>")
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    return stored(rows.filter("n_words > 0").withColumn("block", block), "hashed-items")


def _possible(documents: DataFrame, items: DataFrame, shingles: DataFrame) -> DataFrame:
    """Documents ``(doc_id, digest, text, hits)`` of which some stretch may hold an item; stored.

    ``hits`` are the different shingles that may be an item's. Items are taken by
    powers of two of their numbers of shingles: what a window of the least of them
    needs must stand within a window of the largest.
    """
    short = [r[0] for r in items.filter(F.col("n_words") < SHINGLE_WORDS).select("n_words").distinct().collect()]
    runs = F.col("n_words") - (SHINGLE_WORDS - 1)
    sizes = (
        items.filter(runs > 0)
        .groupBy(F.floor(F.log2(runs)).alias("power"))
        .agg(F.min(runs).alias("least"), F.max(runs).alias("most"))
        .collect()
    )
    stretches = [(r["least"], r["most"]) for r in sizes]
    sent = Sent(documents.sparkSession, bloom_filter(shingles.select("shingle")))

    def dense(hit: np.ndarray) -> bool:
        total = np.concatenate([[0], np.cumsum(hit)])
        for least, most in stretches:
            width = min(most, len(hit))
            needed = SIMILARITY / (1 + SIMILARITY) * (min(least, len(hit)) + least) - 1e-9
            if (total[width:] - total[:-width]).max() >= needed:
                return True
        return False

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = sent.get()
        for batch in small_batches(batches):
            hits = {}
            for rows, data, offsets in byte_chunks(batch["text"]):
                words = find_words(data, offsets)
                hashes = words.hashes()
                for size in [*short, SHINGLE_WORDS]:
                    runs, first = shingle_hashes(hashes, words.first, size)
                    hit = passes(filled, runs)
                    for row in np.unique(np.searchsorted(first, np.flatnonzero(hit), "right") - 1):
                        own, marks = runs[first[row] : first[row + 1]], hit[first[row] : first[row + 1]]
                        if size < SHINGLE_WORDS or dense(marks):
                            hits.setdefault(rows.start + int(row), []).append(np.unique(own[marks]))
            at = sorted(hits)
            found = batch.take(pa.array(at, pa.int64()))
            lists = [np.unique(np.concatenate(hits[i])).view(np.int64) for i in at]
            yield found.append_column("hits", pa.array(lists, pa.list_(pa.int64())))

    rows = documents.mapInArrow(find, "doc_id long, text string, hits array<long>")
    return stored(rows.withColumn("digest", F.sha2("text", 256)), "possible")


def _joined_matches(documents: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Matches ``(digest, item, ...)`` of different texts, stored, and ``(doc_id, digest)``.

    The benchmark is in no one place: a filter of bounded size finds the documents
    that may match, their shingles are joined with the items' to find the blocks of
    items to compare with, and each block meets its texts in groups of bounded size.
    Equal texts are compared once.
    """
    items = _hashed_items(items)
    shingles = items.select(F.explode("shingles").alias("shingle"), "block").distinct()
    shingles = stored(shingles, "item-shingles")
    possible = _possible(documents, items, shingles)
    texts = stored(possible.select("digest", "text", "hits").dropDuplicates(["digest"]), "texts")

    # A shingle that many texts share is dealt out; the items' side is repeated for that.
    deal = F.pmod(F.xxhash64("digest"), F.lit(SHINGLE_SALTS))
    every = F.explode(F.sequence(F.lit(0), F.lit(SHINGLE_SALTS - 1))).alias("salt")
    hits = texts.select(
        "digest", F.octet_length("text").alias("bytes"), deal.cast("int").alias("salt"), F.explode("hits").alias("shingle")
    )
    pairs = hits.join(shingles.select("shingle", "block", every), ["shingle", "salt"])
    pairs = stored(pairs.select("digest", "bytes", "block").distinct(), "pairs")

    parts = F.ceil(F.sum("bytes") / GROUP_BYTES).cast("int")
    blocks = pairs.groupBy("block").agg(F.greatest(parts, F.lit(1)).alias("parts"))
    part = F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")
    left = (
        pairs.join(blocks, "block")
        .select("digest", "block", part.alias("part"))
        .join(texts.select("digest", "text"), "digest")
    )
    right = items.join(blocks, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "item", "text"
    )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["digest", "item", "similarity", "first_word", "n_words"]
        right = right.sort_by("item")
        index = ItemIndex(right["item"].to_pylist(), right["text"].to_pylist())
        got = list(index.matches(left["text"])) if len(left) else []
        digests = left["digest"].combine_chunks().take(pa.array([g[0] for g in got], pa.int64()))
        return pa.table([digests.cast(pa.string()), *_match_columns(index, got)], names)

    keys = ["block", "part"]
    found = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(compare, f"digest string, {_MATCH}")
    return stored(found, "matches"), possible.select("doc_id", "digest")


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows ``(doc_id, item_id, similarity, first_word, n_words)``, one per match.

    A document matches an item if one of its windows of the item's length, or
    the whole of a document that has fewer words, is similar to it at 0.8 or
    more; the best window is named, the first of equals. An item of fewer than
    five words must occur as it is. Null or empty texts and items match nothing;
    repeated rows match each; null ids come back as null. Other columns are not
    read. Equal items are compared once. Up to ``ITEMS_AT_ONCE`` items of together
    ``INDEXED_BYTES`` are sent to the documents, which do not move; more items are
    joined with the documents that may hold one. The documents are read once.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = _items(benchmark)
    sent = _sent_index(items)
    if sent is None:
        matches, places = _joined_matches(rows, items)
        found = places.join(matches, "digest").drop("digest")
    else:

        def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = sent.get()
            for batch in parts:
                got = list(index.matches(batch["text"]))
                if got:
                    ids = batch["doc_id"].take(pa.array([g[0] for g in got], pa.int64()))
                    names = ["doc_id", "item", "similarity", "first_word", "n_words"]
                    yield pa.RecordBatch.from_arrays([ids, *_match_columns(index, got)], names)

        found = rows.mapInArrow(batches, f"doc_id long, {_MATCH}")
    # Rows of the benchmark that repeat a text match each.
    ids = benchmark.select("item_id", F.sha2(F.col("text").cast("string"), 256).alias("item"))
    columns = ("doc_id", "item_id", "similarity", "first_word", "n_words")
    return found.join(ids, "item").select(*columns)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that match no item, with all their columns.

    With more items than are sent to the documents, texts that match are found first
    and then kept out; only documents that a filter of their hashes finds are moved.
    """
    items = _items(benchmark)
    sent = _sent_index(items)
    if sent is not None:

        def clean(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = sent.get()
            for batch in parts:
                keep = np.ones(batch.num_rows, bool)
                for row, *_ in index.matches(batch["text"].cast(pa.string())):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        return documents.mapInArrow(clean, documents.schema)
    rows = documents.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string"))
    matches, _ = _joined_matches(rows, items)
    key, digest = free_name(documents, "text_hash"), free_name(documents, "text_digest")
    bad = matches.select(F.col("digest").alias(digest)).distinct()
    hashes = stored(bad.select(_hash_of(F.col(digest)).alias(key)), "matching")
    own = documents.withColumn(key, _hash_of(F.sha2(F.col("text").cast("string"), 256)))
    moved, others = parted_by(own, hashes, key)
    moved = moved.withColumn(digest, F.sha2(F.col("text").cast("string"), 256)).join(bad, digest, "left_anti")
    return others.select(documents.columns).unionByName(moved.select(documents.columns))


def _hash_of(digest: Column) -> Column:
    """The digest's first 60 bits as a number."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
