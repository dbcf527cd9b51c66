"""The trie of conversation prefixes, from vertical bitmaps.

Conversations are dealt into batches of bounded size, in the order of their ids.
A batch indexes (position, turn) to the bitset of its conversations that have that
turn there. Depth-first, the intersection of a node's bitset with a posting is a
child's bitset; its popcount, lowest bit and the conversations that end there
follow. A node that many batches share is one row of each, so a first turn, or a
whole conversation, that a third of all rows have is a row per batch and no more.

What lies below a node is summed twice: within each batch over the nodes whose
least conversation is in the batch, then over batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .store import stored

# Most conversations of a batch, and turns after which it takes no further one.
BATCH_CONVERSATIONS = 4_096
BATCH_TURNS = 65_536

# Conversations of one block may begin with the turns of the block's first.
BLOCK = 100
MAX_HEAD = 5

_ROOT = bytes(16)
_NODES = (
    "batch long, key binary, parent binary, depth long, n_convs long, conv_id long, "
    "n_chars long, ends binary"
)


def turn_columns(role: Column, text: Column) -> list[Column]:
    """The identity of a turn in 16 bytes, and the code points of its text."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    # The role's length keeps (a, bc) apart from (ab, c).
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return [F.unhex(F.md5(whole)).alias("key"), F.char_length(text).cast("long").alias("n_chars")]


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """Rows ``(conv_id, part, pos, key, n_chars)`` of the conversations to index.

    Conversation ``c`` begins with the first ``crc32(c) % 6`` turns of
    ``c - c % 100``, and goes on with its own turns after as many. The turns of
    one conversation are ordered by ``(part, pos)``; a row of part 0 without a key
    says that the conversation exists.
    """
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")
    turns = stored(
        conversations.filter("conv_id is not null")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            *turn_columns(F.col("role"), F.col("text")),
        )
        .withColumn("pos", F.row_number().over(order).cast("long"))
        .drop("turn"),
        "trie-turns",
    )
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MAX_HEAD + 1))
    block = F.col("conv_id") - F.col("conv_id") % BLOCK
    # Every conversation has one turn of pos 1; the heads lent are five turns at most.
    convs = turns.filter("pos = 1").select("conv_id", head.alias("head"), block.alias("block"))
    lent = (
        turns.filter((F.col("pos") <= MAX_HEAD) & (F.col("conv_id") % BLOCK == 0))
        .groupBy(F.col("conv_id").alias("block"))
        .agg(F.collect_list(F.struct("pos", "key", "n_chars")).alias("turns"))
    )
    nothing = F.struct(
        F.lit(0).cast("long").alias("pos"),
        F.lit(None).cast("binary").alias("key"),
        F.lit(0).cast("long").alias("n_chars"),
    )
    used = F.filter(F.coalesce("turns", F.array()), lambda t: t["pos"] <= F.col("head"))
    heads = (
        convs.join(lent, "block", "left")
        .select("conv_id", F.explode(F.array_append(used, nothing)).alias("t"))
        .select("conv_id", F.lit(0).alias("part"), "t.pos", "t.key", "t.n_chars")
    )
    own = turns.filter(F.col("pos") > head).select(
        "conv_id", F.lit(1).alias("part"), "pos", "key", "n_chars"
    )
    return heads.unionByName(own)


def _child_key(parent: bytes, turn: bytes) -> bytes:
    return hashlib.md5(parent + turn).digest()


def _batch_nodes(convs: list[tuple[int, list[tuple[bytes, int]]]]) -> Iterator[tuple]:
    """Nodes of the trie of some conversations, given in ascending order of their ids."""
    postings: dict[tuple[int, bytes], int] = {}
    ends: dict[int, int] = {}
    for bit, (_, turns) in enumerate(convs):
        one = 1 << bit
        for at, (turn, _) in enumerate(turns):
            postings[at, turn] = postings.get((at, turn), 0) | one
        ends[len(turns)] = ends.get(len(turns), 0) | one
    stack = [((1 << len(convs)) - 1, 0, _ROOT, None, 0)]
    while stack:
        bits, depth, key, parent, n_chars = stack.pop()
        least = (bits & -bits).bit_length() - 1
        here, listed = bits & ends.get(depth, 0), []
        rest = bits ^ here
        while here:
            low = here & -here
            listed.append(b"%d" % convs[low.bit_length() - 1][0])
            here ^= low
        yield (
            key,
            parent,
            depth,
            bits.bit_count(),
            convs[least][0],
            n_chars,
            b",".join(listed) if listed else None,
        )
        while rest:
            # The first conversation not yet placed names the next child.
            turn, size = convs[(rest & -rest).bit_length() - 1][1][depth]
            child = bits & postings[depth, turn]
            rest &= ~child
            stack.append((child, depth + 1, _child_key(key, turn), key, size))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes per batch of conversations; rows come sorted by conversation and turn."""
    convs: list = []
    n_turns = 0

    def flush() -> Iterator[pa.RecordBatch]:
        # Batches hold disjoint runs of ids, so the least one names the batch.
        rows = []
        for node in _batch_nodes(convs):
            rows.append((convs[0][0], *node))
            if len(rows) == 8_192:
                yield _node_rows(rows)
                rows = []
        if rows:
            yield _node_rows(rows)

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(3)]
        for conv_id, key, n_chars in zip(*columns, strict=True):
            if not convs or convs[-1][0] != conv_id:
                if len(convs) >= BATCH_CONVERSATIONS or n_turns >= BATCH_TURNS:
                    yield from flush()
                    convs, n_turns = [], 0
                convs.append((conv_id, []))
            if key is not None:
                convs[-1][1].append((key, n_chars))
                n_turns += 1
    if convs:
        yield from flush()


_NODE_TYPES = [
    ("batch", pa.int64()),
    ("key", pa.binary()),
    ("parent", pa.binary()),
    ("depth", pa.int64()),
    ("n_convs", pa.int64()),
    ("conv_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("ends", pa.binary()),
]


def _node_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _NODE_TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in _NODE_TYPES])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key from rows sorted by key and batch; end lists are hashed as they pass."""
    names = ("key", "parent", "n_convs", "conv_id", "n_chars", "ends_sha256")
    node, sha, any_end, out = None, None, False, []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    for batch in batches:
        columns = [
            batch.column(k).to_pylist()
            for k in ("key", "parent", "n_convs", "conv_id", "n_chars", "ends")
        ]
        for key, parent, n, conv_id, n_chars, ends in zip(*columns, strict=True):
            if node is None or node[0] != key:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha, any_end = [key, parent or b"", 0, conv_id, n_chars], hashlib.sha256(), False
            node[2] += n
            if ends is not None:
                sha.update(b"," + ends if any_end else ends)
                any_end = True
        if out:
            yield rows()
            out.clear()
    if node is not None:
        out.append((*node, sha.hexdigest()))
        yield rows()


def _below(table: pa.Table) -> pa.Table:
    """Sums over each node's subtree of what the batch owns, and its parent's conversation."""
    keys = table.column("key").to_pylist()
    at = {key: i for i, key in enumerate(keys)}
    parent = np.array([at.get(p, -1) for p in table.column("parent").to_pylist()], np.int64)
    depth, least, n_convs, n_chars, n_children, batch_least = (
        table.column(c).to_numpy()
        for c in ("depth", "conv_id", "n_convs", "n_chars", "n_children", "own_least")
    )
    # The node's least conversation is in this batch if it is the least one here too.
    own = least == batch_least
    leaves = np.where(own & (n_children == 0), 1, 0).astype(np.int64)
    saved = np.where(own, (n_convs - 1) * n_chars, 0).astype(np.int64)
    order = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, edges):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    up = np.where(parent >= 0, least[parent], 0)
    return pa.table(
        {
            "key": table.column("key").combine_chunks(),
            "depth": depth,
            "conv_id": least,
            "parent_conv_id": pa.array(up, mask=parent < 0),
            "n_convs": n_convs,
            "n_children": n_children,
            "n_leaves": leaves,
            "saved_tokens": saved,
            "ends_sha256": pa.array(table.column("ends_sha256").to_pylist(), pa.string()),
        }
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``rebuilt_turns``).

    Columns: ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``. Turns stand by ``turn``, nulls first; of turns that tie, the
    one whose digest is least comes first, and repeated rows are turns of their
    own. Null roles and texts count as empty. Rows without a ``conv_id`` belong to
    no conversation and are left out. Other columns are not read. An empty table
    has no root and gives no rows. A task holds the turns of one batch as 16 bytes
    each, and so those of the longest conversation.
    """
    rows = rebuilt_turns(conversations)
    width = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(width, "conv_id").sortWithinPartitions(
        "conv_id", "part", F.asc_nulls_last(F.when(F.col("key").isNotNull(), F.col("pos")))
    )
    nodes = stored(sorted_rows.select("conv_id", "key", "n_chars").mapInArrow(_index, _NODES), "trie-nodes")
    merged = stored(
        nodes.repartition(width, "key")
        .sortWithinPartitions("key", "batch")
        .mapInArrow(
            _merge,
            "key binary, parent binary, n_convs long, conv_id long, n_chars long, ends_sha256 string",
        ),
        "trie-merged",
    )
    children = merged.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    whole = merged.join(children, "key", "left").select(
        "key", "n_convs", "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children"), "ends_sha256"
    )
    placed = nodes.select(
        "batch", "key", "parent", "depth", "n_chars", F.col("conv_id").alias("own_least")
    ).join(whole, "key")
    below = placed.groupBy("batch").applyInArrow(
        _below,
        "key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, ends_sha256 string",
    )
    same = ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children")
    return (
        below.groupBy("key")
        .agg(
            *(F.max(c).alias(c) for c in same),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"),
            F.max("ends_sha256").alias("ends_sha256"),
        )
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            "ends_sha256",
        )
    )
