"""Near-duplicate groups by HyperMinHash.

The 64-bit hash of a shingle names one of 256 buckets with its first 8 bits. A
bucket keeps the least of its other 56 bits, compressed to the count of leading
zeros and the ten bits after the first one: 16 bits in all. Buckets that no
shingle of a short text reaches borrow the register of another bucket, by a
fixed random order, so that any register of two texts agrees with a probability
equal to their similarity.

Six registers form a band. Texts that agree in a band are candidates; two texts
at a similarity of 0.85 miss all 42 bands with a probability of 2e-9. The share
of agreeing registers, less the collisions expected by chance, estimates the
similarity; what lies five standard errors below the threshold is let go, and
the full shingle sets decide about the rest.

Texts with equal sets form a class, and one member stands for it from then on.
In a bucket of candidates, every class is compared with the least one first.
What is then in one component needs no more links; only members of different
components that still share a bucket are compared with one another. So a bucket
of n copies costs n comparisons, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .components import connected_components
from .id_filter import maybe_among, parted_by
from .store import stored
from .words import byte_chunks, find_words, mix, per_batch, shingle_hashes

BUCKETS = 256
MANTISSA_BITS = 10
BAND_ROWS = 6
BANDS = BUCKETS // BAND_ROWS
PERCENT = 85
ERRORS = 5

_U = np.uint64


def _borrow_order() -> np.ndarray:
    """For each bucket, all buckets in a fixed random order, itself first."""
    key = mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64), 11).reshape(BUCKETS, BUCKETS)
    key[np.arange(BUCKETS), np.arange(BUCKETS)] = 0
    return np.argsort(key, axis=1)


_ORDER = _borrow_order()


def compress(rest: np.ndarray) -> np.ndarray:
    """Leading zeros (6 bits) and mantissa (10 bits) of 56-bit values as 16 bits."""
    _, exponent = np.frexp((rest >> _U(3)).astype(np.float64))
    zeros = (53 - exponent).clip(0, 56).astype(np.uint64)
    mantissa = (rest << (zeros + _U(9))) >> _U(64 - MANTISSA_BITS)
    return ((zeros << _U(MANTISSA_BITS)) | mantissa).astype(np.uint16)


def sketch_set(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Registers of a sorted array of distinct hashes, and which buckets hold one."""
    bucket = (values >> _U(56)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    registers, filled = np.zeros(BUCKETS, np.uint16), np.zeros(BUCKETS, bool)
    at = bucket[first]
    registers[at] = compress(values[first] & _U(2**56 - 1))
    filled[at] = True
    if len(at) < BUCKETS:
        empty = np.flatnonzero(~filled)
        order = _ORDER[empty]
        registers[empty] = registers[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return registers, filled


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text in turn."""
    for _, data, offsets in byte_chunks(column):
        words = find_words(data, offsets)
        hashes, first = shingle_hashes(words.hashes(), words.first)
        for a, b in zip(first[:-1], first[1:], strict=True):
            yield np.unique(hashes[a:b])


_SKETCH = per_batch(
    ["doc_id", "n_shingles", "set_a", "set_b", "registers", "filled"],
    [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()],
)
_SKETCH_TYPE = (
    "doc_id long, n_shingles long, set_a long, set_b long, registers binary, filled binary"
)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, a, b, registers, filled = [], [], [], [], []
        for values in shingle_sets(batch["text"]):
            n.append(len(values))
            a.append(int(mix(values, 21).sum(dtype=np.uint64).astype(np.int64)))
            b.append(int(mix(values, 22).sum(dtype=np.uint64).astype(np.int64)))
            one, full = sketch_set(values) if len(values) else (None, None)
            registers.append(None if one is None else one.astype(">u2").tobytes())
            filled.append(None if full is None else np.packbits(full).tobytes())
        yield _SKETCH(batch["doc_id"], n, a, b, registers, filled)


def sketch(documents: DataFrame) -> DataFrame:
    """Per row: number and 128-bit digest of its shingles, registers, filled buckets."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_sketch_batches, _SKETCH_TYPE)


_COUNT_BITS = np.array([bin(i).count("1") for i in range(256)], np.int64)


def chance_collisions(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Registers of two disjoint sets expected to agree by chance.

    A bucket's least value is about exponential in the set's rate; within a
    level of leading zeros all mantissa cells are equally wide, so the sum over
    cells is an integral per level.
    """
    rate_a, rate_b = n_a[:, None] / BUCKETS, n_b[:, None] / BUCKETS
    low = 2.0 ** -np.arange(1.0, 48.0)[None, :]
    cell = low / 2**MANTISSA_BITS
    both = rate_a + rate_b
    share = (np.exp(-both * low) - np.exp(-both * 2 * low)) * rate_a * rate_b / both * cell
    return BUCKETS * share.sum(axis=1)


def estimate(reg_a, reg_b, fill_a, fill_b, n_a, n_b) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected similarity and its standard error at the threshold.

    Each filled bucket draws one shingle of the union, none twice, so the error
    shrinks as the draws use the union up.
    """
    fill_a, fill_b = (np.unpackbits(x, axis=1).astype(bool) for x in (fill_a, fill_b))
    agree = ((reg_a == reg_b) & fill_a & fill_b).sum(axis=1)
    used = (fill_a | fill_b).sum(axis=1).clip(1)
    similarity = (agree - chance_collisions(n_a, n_b)) / used
    t = PERCENT / 100
    union = np.maximum((n_a + n_b) / (1 + t), used + 1)
    return similarity, np.sqrt(t * (1 - t) / used * np.maximum(1 - used / union, 0.05))


def _stacked(column: pa.Array, dtype: str) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype).reshape(len(column), -1)


def _likely_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        n = [batch[f"n_{x}"].to_numpy().astype(float) for x in "ab"]
        value, error = estimate(
            *(_stacked(batch[f"registers_{x}"], ">u2") for x in "ab"),
            *(_stacked(batch[f"filled_{x}"], "u1") for x in "ab"),
            *n,
        )
        keep = (value >= PERCENT / 100 - ERRORS * error) & (
            100 * np.minimum(*n) >= PERCENT * np.maximum(*n)
        )
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def likely_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The candidate pairs ``(a, b)`` whose estimate does not rule a link out."""
    for side in "ab":
        own = classes.select(
            F.col("node").alias(side),
            *(F.col(c).alias(f"{c}_{side}") for c in ("n", "registers", "filled")),
        )
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(_likely_batches, "a long, b long")


def _linked_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets_a, sets_b = shingle_sets(batch["text_a"]), shingle_sets(batch["text_b"])
        keep = []
        for x, y in zip(sets_a, sets_b, strict=True):
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(len(x) > 0 and 100 * common >= PERCENT * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _texts_of(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows ``(doc_id, text)`` of the stored ids; a Bloom filter stops most others from moving."""
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return maybe_among(texts, ids).join(ids, "doc_id", "left_semi")


def confirmed_links(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = stored(_texts_of(stored(needed, "needed"), documents), "texts")
    for side in "ab":
        own = texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(_linked_batches, "a long, b long").distinct()


def _band_keys(classes: DataFrame) -> DataFrame:
    width = 2 * BAND_ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.col("registers").substr(b * width + 1, F.lit(width))),
    )
    return classes.select("node", F.explode(bands).alias("key"))


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    build = per_batch(["node", "shingle"], [pa.int64(), pa.int64()])
    for batch in batches:
        for node, values in zip(batch["doc_id"].to_pylist(), shingle_sets(batch["text"]), strict=True):
            yield build(np.full(len(values), node), values.view(np.int64))


def _with_possible_partner(members: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """The rows ``(key, node, component)`` that may still have a link in their bucket.

    Adds ``n``, the size of the node's set, and ``common``, the shingles that it
    shares with any other text still in question. No intersection is larger, so
    a text with too many shingles of its own drops out here, before pairs form.
    ``keys`` lists the buckets where the node is left.
    """
    nodes = stored(members.select(F.col("node").alias("doc_id")).distinct(), "nodes")
    # Stored, so that no task keeps two Python workers, one to filter and one to cut shingles.
    texts = stored(_texts_of(nodes, documents), "texts")
    nodes = nodes.withColumnRenamed("doc_id", "node")
    own = (
        texts.mapInArrow(_shingle_batches, "node long, shingle long")
        .groupBy("shingle")
        .agg(F.min("node").alias("node"), F.max("node").alias("last"))
        .filter("node = last")
        .groupBy("node")
        .agg(F.count("*").alias("own"))
    )
    # A node that stands for several sets is not ruled out by what they hold together.
    sets = classes.groupBy("node").agg(F.collect_set("n").alias("n"), F.count("*").alias("sets"))
    sets = sets.select("node", F.explode("n").alias("n"), "sets")
    unshared = F.when(F.col("sets") == 1, F.coalesce("own", F.lit(0))).otherwise(0)
    sizes = (
        nodes.join(sets, "node")
        .join(own, "node", "left")
        .select("node", "n", (F.col("n") - unshared).alias("common"))
    )
    sized = stored(members.join(sizes, "node"), "sized")
    least = sized.groupBy("key").agg(F.min("n").alias("least"))
    best = F.col("n") + F.greatest("common", "least") - F.col("common")
    possible = sized.join(least, "key").filter(100 * F.col("common") >= PERCENT * best)
    possible = stored(possible.drop("least"), "possible")
    # All its buckets, at most one per band, so that a pair can form in the least alone.
    keys = possible.groupBy("node").agg(F.collect_set("key").alias("keys"))
    return possible.join(keys, "node")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id and kept.

    Two texts are linked if 100 * common shingles >= 85 * all their shingles.
    ``component_id`` is the least doc_id reachable by links, ``kept`` marks the
    row that has it. Texts without words, or null, have no shingle and no link.
    Rows that repeat a doc_id count as one document with all their texts, and
    all come back. A null doc_id takes no part: its component is null and it is
    kept. An empty table gives no rows. Columns other than doc_id and text are
    ignored.
    """
    sketches = stored(sketch(documents), "sketches")
    usable = sketches.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(
        usable.groupBy("set_a", "set_b").agg(
            F.min("doc_id").alias("node"),
            F.max("n_shingles").alias("n"),
            F.max("registers").alias("registers"),
            F.max("filled").alias("filled"),
        ),
        "classes",
    )
    keys = _band_keys(classes)
    pivots = (
        keys.groupBy("key")
        .agg(F.min("node").alias("a"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "a")
    )
    shared = stored(keys.join(pivots, "key"), "shared")
    stars = shared.filter("node > a").select("a", F.col("node").alias("b")).distinct()
    # One doc_id with several texts links their classes.
    repeated = usable.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    several = stored(
        usable.join(repeated, "doc_id", "left_semi")
        .join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
        .select("doc_id", "node")
        .distinct(),
        "several",
    )
    same_id = several.join(several.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id")
    same_id = same_id.filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    likely = stored(likely_pairs(stars, classes), "likely")
    links = confirmed_links(likely, documents).unionByName(same_id.select("a", "b"))
    links = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "first")
    parts = stored(connected_components(links), "parts")

    placed = shared.select("key", "node").join(parts, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    mixed = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("key")
    )
    left = stored(placed.join(mixed, "key", "left_semi"), "mixed")
    left = _with_possible_partner(left, classes, documents)
    right = left.select("key", *(F.col(c).alias(f"other_{c}") for c in left.columns if c != "key"))
    common = F.least("common", "other_common")
    rest = (
        left.join(right.withColumnRenamed("key", "other_key"), F.col("key") == F.col("other_key"))
        .filter(F.col("component") < F.col("other_component"))
        .filter(
            ~F.exists("keys", lambda k: (k < F.col("key")) & F.array_contains("other_keys", k))
        )
        .filter(100 * common >= PERCENT * (F.col("n") + F.col("other_n") - common))
        .select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    more = confirmed_links(stored(likely_pairs(rest, classes), "likely"), documents)
    more = stored(more.select(F.col("a").alias("u"), F.col("b").alias("v")), "second")
    # What is linked already goes on as stars, which need no further rounds.
    stars = parts.select(F.col("node").alias("u"), F.col("component").alias("v"))
    parts = connected_components(stars.unionByName(more))

    classed = (
        sketches.join(
            classes.select("set_a", "set_b", "node"), ["set_a", "set_b"], "left"
        )
        .withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node")))
        .select("doc_id", "n_shingles", "node")
    )
    joined = classed.join(parts, "node", "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")
    )
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """The rows that ``near_duplicates`` keeps, with all their columns.

    Of rows that repeat a doc_id one stays, that of the least text (then the least
    hash of all columns). Rows with a null doc_id stay. Only rows that a Bloom filter
    takes for dropped or repeated move.
    """
    found = near_duplicates(documents).filter("doc_id is not null")
    ids = stored(
        found.groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("n")).filter("not kept or n > 1"),
        "dropped",
    )
    among, others = parted_by(documents, ids.select("doc_id"))
    # A name that no column of the documents has.
    fate = "_" * (1 + max(map(len, documents.columns))) + "fate"
    fates = ids.select("doc_id", F.struct("kept", "n").alias(fate))
    moved = among.join(fates, "doc_id", "left")
    alone = moved.filter(F.col(fate).isNull()).select(documents.columns)
    again = moved.filter(F.col(fate)["kept"] & (F.col(fate)["n"] > 1))
    order = W.partitionBy("doc_id").orderBy("text", F.xxhash64(F.to_json(F.struct(*documents.columns))))
    first = again.withColumn(fate, F.row_number().over(order)).filter(F.col(fate) == 1)
    return others.unionByName(alone).unionByName(first.select(documents.columns))
