"""Near duplicates by SimHash fingerprints and vantage-point trees.

Distinct fingerprints are dealt to shards by three vantage-point trees. Two
fingerprints that differ in at most four bits differ in at most one bit of some
third of the 64, so tree ``t`` measures distance on third ``t`` alone and has a
radius of one: on whole fingerprints nearly every distance lies within four of
the median, and the triangle bounds would prune next to nothing. Found pairs are
tested on all 64 bits.

A tree's vantage points come from a bounded sample; which shards exist depends on
it, which links are found does not. Every fingerprint has one home shard per tree
and visits the later shards that its distances cannot rule out. A shard's
residents and its visitors are each cut into chunks of bounded size, and each pair
of chunks is a group of its own, so no task holds an unbounded shard. Visitors
grow by a third with each level of a tree, so shards are large and are searched
with a tree of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .store import Sent, stored

SHINGLE = 4
RADIUS = 4
SEED = 42

# Which bits each tree looks at, and how far apart linked fingerprints can be there.
BLOCKS = tuple(((1 << hi) - (1 << lo)) for lo, hi in ((0, 22), (22, 43), (43, 64)))
BLOCK_RADIUS = RADIUS // len(BLOCKS)

# Residents per shard that a tree aims at; residents and visitors per chunk.
SHARD = 16_384
CHUNK = 65_536
VISITORS = 4 * CHUNK
# Shards per tree, and sampled fingerprints per shard: 16 MB of vantage points and
# 16 MB of sample at most.
MAX_SHARDS = 1 << 17
SAMPLED_PER_SHARD = 16
# Below this many pairs a comparison of all is cheaper than another split.
_FEW = 1 << 15
_RUN = 1 << 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes) -> int:
    """The unsigned 64-bit SimHash of one UTF-8 text."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, _RUN):
        froms = starts[k : min(k + _RUN, n)].tolist()
        tos = (ends[k + size - 1 : min(k + _RUN, n) + size - 1] - 1).tolist()
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(froms, tos, strict=True)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def with_fingerprint(documents: DataFrame) -> DataFrame:
    """Rows ``(doc_id, fp)``; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
            values = [fingerprint(t.as_py() or b"") for t in texts]
            fps = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


@dataclass
class Tree:
    """A vantage-point tree over one block of bits, as arrays by node.

    ``left`` is the child within ``reach`` of ``point``, ``right`` the other one;
    a negative child ``-1 - s`` is shard ``s``. Shards are numbered from left to right.
    """

    mask: int
    point: np.ndarray
    reach: np.ndarray
    left: np.ndarray
    right: np.ndarray
    root: int

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, their shards, and whether the shard is the row's home.

        Of two fingerprints within the radius that have different homes, the one
        whose home comes first visits the other's.
        """
        mask, r = np.uint64(self.mask), BLOCK_RADIUS
        row, node = np.arange(len(fps)), np.full(len(fps), self.root)
        home, out = np.ones(len(fps), bool), []
        while len(row):
            done = node < 0
            if done.any():
                out.append((row[done], -1 - node[done], home[done]))
                row, node, home = row[~done], node[~done], home[~done]
                if not len(row):
                    break
            d = np.bitwise_count((fps[row] ^ self.point[node]) & mask).astype(np.int64)
            reach = self.reach[node]
            inner = d <= reach
            to_left = np.where(home, inner, d - r <= reach)
            stays = np.where(home, ~inner, d + r > reach)  # to the right, as what it was
            visits = home & inner & (d + r > reach)
            pick = [(to_left, self.left, home), (stays, self.right, home)]
            pick.append((visits, self.right, np.zeros(len(row), bool)))
            row, node, home = (
                np.concatenate(x)
                for x in zip(*[(row[k], side[node[k]], h[k]) for k, side, h in pick], strict=True)
            )
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def build_tree(sample: np.ndarray, mask: int, shards: int, seed: int = 0) -> Tree:
    """A tree of at most ``shards`` shards, from a sample of the fingerprints."""
    rng = np.random.default_rng(seed)
    nodes, next_shard = [], [0]

    def grow(part: np.ndarray, wanted: int) -> int:
        if wanted > 1 and len(part) > 1:
            for at in rng.integers(0, len(part), 4):
                d = np.bitwise_count((part ^ part[at]) & np.uint64(mask))
                reach = int(np.median(d))
                if reach == d.max():
                    reach -= 1
                inner = d <= reach
                if inner.any() and not inner.all():
                    me = len(nodes)
                    nodes.append([int(part[at]), reach, 0, 0])
                    nodes[me][2] = grow(part[inner], wanted // 2)
                    nodes[me][3] = grow(part[~inner], wanted - wanted // 2)
                    return me
        next_shard[0] += 1
        return -next_shard[0]

    root = grow(sample, shards)
    columns = list(zip(*nodes, strict=True)) or [[], [], [], []]
    kinds = (np.uint64, np.int64, np.int64, np.int64)
    return Tree(mask, *(np.array(c, k) for c, k in zip(columns, kinds, strict=True)), root)


class _Unions:
    """Groups of the numbers below ``n``; whole arrays of links at a time."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, of: np.ndarray) -> np.ndarray:
        at = self.parent[of]
        while True:
            up = self.parent[at]
            if (up == at).all():
                return at
            at = up

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            self.parent[np.maximum(ra, rb)] = np.minimum(ra, rb)


def _pairs(fps: np.ndarray, a: np.ndarray, b: np.ndarray, unions: _Unions) -> None:
    """Compare each of ``a`` with each of ``b``, a bounded block at a time."""
    step = max(1, 64 * _FEW // max(1, len(b)))
    for k in range(0, len(a), step):
        some = a[k : k + step]
        near = np.bitwise_count(fps[some][:, None] ^ fps[b][None, :]) <= RADIUS
        i, j = np.nonzero(near)
        unions.unite(some[i], b[j])


def _split(fps: np.ndarray, rows: np.ndarray, mask: np.uint64):
    """A vantage point and a reach that split the rows, or None if all look alike."""
    for at in (0, len(rows) // 2, len(rows) - 1):
        point = fps[rows[at]]
        d = np.bitwise_count((fps[rows] ^ point) & mask).astype(np.int64)
        reach = int(np.median(d))
        reach -= reach == d.max()
        if 0 <= reach < d.max():
            return point, reach, d
    return None


def _join(fps, a, b, mask, unions, same: bool) -> None:
    """Find links between ``a`` and ``b`` (or within ``a``), pruned by triangle bounds."""
    r, todo = BLOCK_RADIUS, [(a, b, same)]
    while todo:
        a, b, same = todo.pop()
        if not len(a) or not len(b):
            continue
        if len(a) < len(b):
            a, b = b, a
        found = _split(fps, a, mask) if len(a) * len(b) > _FEW else None
        if found is None:
            _pairs(fps, a, b, unions)
            continue
        point, reach, da = found
        db = da if same else np.bitwise_count((fps[b] ^ point) & mask).astype(np.int64)
        inner, outer = da <= reach, db > reach
        todo.append((a[inner], b[~outer], same))
        todo.append((a[~inner], b[outer], same))
        todo.append((a[inner & (da + r > reach)], b[outer & (db - r <= reach)], False))
        if not same:
            todo.append((a[~inner & (da - r <= reach)], b[~outer & (db + r > reach)], False))


def _cell_links(fps: np.ndarray, home: np.ndarray, side: np.ndarray, own: bool, mask: int):
    """A spanning forest of the links in one group of rows: two arrays of fingerprints.

    Residents of one chunk (``side`` all alike) are compared among themselves if
    ``own``, and with the visitors; those of two chunks across. Two visitors need
    no comparison.
    """
    unions, mask = _Unions(len(fps)), np.uint64(mask)
    homes, visitors = np.flatnonzero(home), np.flatnonzero(~home)
    if len(homes):
        first = side[homes] == side[homes].min()
        if own:
            _join(fps, homes, homes, mask, unions, True)
        else:
            _join(fps, homes[first], homes[~first], mask, unions, False)
        _join(fps, homes, visitors, mask, unions, False)
    roots = unions.roots(np.arange(len(fps)))
    moved = roots != np.arange(len(fps))
    return fps[moved].view(np.int64), fps[roots[moved]].view(np.int64)


def fingerprint_links(fingerprints: DataFrame, n: int) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints, enough to connect all that link.

    ``fingerprints`` is a stored table of ``n`` distinct longs ``fp``.
    """
    shards = int(min(MAX_SHARDS, max(1, -(-n // SHARD))))
    share = min(1.0, SAMPLED_PER_SHARD * shards / max(1, n))
    # The 20 bits of a hash draw the same rows in every run.
    drawn = fingerprints.filter(
        F.xxhash64("fp").bitwiseAND(F.lit((1 << 20) - 1)) < F.lit(int(share * (1 << 20)) + 1)
    )
    sample = np.sort(drawn.select("fp").toArrow()["fp"].to_numpy()).view(np.uint64)
    trees = Sent(
        fingerprints.sparkSession,
        [build_tree(sample, mask, shards, seed) for seed, mask in enumerate(BLOCKS)],
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = trees.get()
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for t, tree in enumerate(own):
                row, shard, home = tree.route(fps)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), t, np.int32)),
                        pa.array(shard.astype(np.int32)),
                        pa.array(fps[row].view(np.int64)),
                        pa.array(home),
                    ],
                    ["tree", "shard", "fp", "home"],
                )

    schema = "tree int, shard int, fp long, home boolean"
    dealt = stored(fingerprints.select("fp").mapInArrow(deal, schema), "simhash-dealt")
    resident = F.col("home").cast("long")
    sizes = dealt.groupBy("tree", "shard").agg(
        F.ceil(F.sum(resident) / CHUNK).alias("chunks"),
        F.ceil(F.greatest(F.sum(1 - resident), F.lit(1)) / VISITORS).alias("visits"),
    )
    # Chunk c of k residents meets all k: cells (c, x) and (x, c), the lesser first. The
    # first chunk of visitors joins the cells (c, c), a later one y has cells (c, k + y).
    side = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.when(F.col("home"), F.col("chunks")).otherwise(F.col("visits")))
    last = F.col("chunks") - 1 + F.when(F.col("home"), F.col("visits") - 1).otherwise(0)
    met = F.col("met") < F.col("chunks")
    pair = (F.least("side", "met"), F.greatest("side", "met"))
    low = F.when(F.col("home"), F.when(met, pair[0]).otherwise(F.col("side"))).otherwise(F.col("met"))
    high = (
        F.when(F.col("home"), F.when(met, pair[1]).otherwise(F.col("met") + 1))
        .when(F.col("side") == 0, F.col("met"))
        .otherwise(F.col("chunks") + F.col("side"))
    )
    cells = (
        dealt.join(sizes.filter("chunks > 0"), ["tree", "shard"])
        .withColumn("side", side)
        .withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .select("tree", "shard", low.alias("low"), high.alias("high"), "side", "fp", "home")
    )

    def compare(table: pa.Table) -> pa.Table:
        mask = BLOCKS[table.column("tree")[0].as_py()]
        fps = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
        own = table.column("low")[0] == table.column("high")[0]
        u, v = _cell_links(fps, home, table.column("side").to_numpy(), own, mask)
        return pa.table({"u": u, "v": v})

    keys = ("tree", "shard", "low", "high")
    return stored(cells.groupBy(*keys).applyInArrow(compare, "u long, v long"), "simhash-links")


def simhash_components(documents: DataFrame) -> DataFrame:
    """Rows ``(doc_id, fingerprint, component_id)``, one per row of ``documents``.

    Texts are compared by lower-cased words in shingles of four, repeats included;
    a text of fewer words is one shingle. A null or empty text has fingerprint
    zero and links like any other. Fingerprints link at four or fewer differing
    bits; ``component_id`` is the least ``doc_id`` reachable. Equal rows give equal
    rows. Rows that repeat a ``doc_id`` with other texts count each for itself and
    bear that id; a null id has its text's component and names none. Other
    columns are not read. An empty table gives no rows.
    """
    rows = stored(with_fingerprint(documents), "simhash")
    groups = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-groups")
    links = fingerprint_links(groups, groups.count())
    members = connected_components(links)
    # A fingerprint without links is its own component.
    placed = groups.join(members, groups["fp"] == members["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
