"""Cheapest repair of conversations, on an automaton shared by all of them.

A conversation's rows become a signature: one letter per row for its role and
fault. Distinct signatures, sorted by their letters from the end, build the
suffix-shared automaton: a node is a distinct suffix, so a signature adds nodes
only for what it does not share with the one before it, and the nodes in memory are
those of one signature. Each node holds, per state of the role grammar, the cost
to go and the first edit of the least audit; this is computed once per node,
however many conversations end in that suffix.

Texts move once, when the audit is applied. Both passes read rows sorted by
conversation as a stream, so a task holds the signature and the digests of one
conversation, not its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

SPACE = "\x20\t\n\x0b\x0c\r"
STOPS = ".!?"

# What an edit costs.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 3, 4, 3, 3
_NEVER = 1 << 60

# Grammar `(s?(ua)+)?`: states and the one role that each lets an edit set next.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_ROLES = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}

# Letters of a signature: blank or duplicate rows; then by role, whole and truncated.
_MUST_GO = "x"
_LETTER = {"s": "sS", "u": "uU", "a": "aA"}
_OTHER = "oO"

DEALT = "conv_id {id}, turn {turn}, role string, text string, gone boolean"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by a hash of ``conv_id:turn``.

    Columns ``conv_id, turn, role, text, gone``; dropped rows stay, with ``gone``
    set, so that their conversation is still known. A null role, text or turn counts
    as one space, also in the hash.
    """

    def whole(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(whole("conv_id"), F.lit(":"), whole("turn"))
    fault = F.crc32(key.cast("binary")) % 20
    text = (
        F.when(fault == 1, F.lit(""))
        .when(fault == 2, F.translate(whole("text"), STOPS, ""))
        .otherwise(whole("text"))
    )
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(whole("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


class Row(NamedTuple):
    """What is known of one row before its conversation is repaired."""

    initial: str
    fault: str


def letter(row: Row) -> str:
    if row.fault in ("blank", "duplicate"):
        return _MUST_GO
    return _LETTER.get(row.initial, _OTHER)[row.fault == "truncated"]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from rows sorted by conversation and turn."""
    names = (
        "place", "conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal",
    )
    out: list[tuple] = []
    state: dict | None = None

    def close() -> None:
        turns = state["turns"]
        gaps = 0 if not state["n_turns"] else turns[1] - turns[0] + 1 - state["n_turns"]
        counts = state["counts"]
        out.append(
            (
                state["place"],
                state["conv_id"],
                "".join(state["letters"]),
                gaps,
                counts["blank"],
                counts["duplicate"],
                counts["truncated"],
                state["illegal"],
            )
        )

    def rows(types) -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )

    types = None
    for batch in batches:
        types = types or [pa.binary(), batch.schema.field("conv_id").type, pa.string()] + [pa.int64()] * 5
        columns = [batch.column(c).to_pylist() for c in _FEATURES]
        for place, conv_id, turn, initial, blank, ended, digest, gone in zip(*columns, strict=True):
            if state is None or state["place"] != place:
                if state is not None:
                    close()
                state = {
                    "place": place, "conv_id": conv_id, "letters": [], "seen": set(), "last": None,
                    "turns": None, "n_turns": 0, "illegal": 0,
                    "counts": {"blank": 0, "duplicate": 0, "truncated": 0, "": 0},
                }
            if gone:
                continue
            if turn is not None:
                # Turns ascend, so the distinct ones are counted as they change.
                if state["turns"] is None:
                    state["turns"], state["n_turns"] = [turn, turn], 1
                elif turn != state["turns"][1]:
                    state["turns"][1] = turn
                    state["n_turns"] += 1
            fault = (
                "blank" if blank
                else "duplicate" if digest in state["seen"]
                else "" if ended
                else "truncated"
            )
            state["seen"].add(digest)
            state["counts"][fault] += 1
            state["letters"].append(letter(Row(initial, fault)))
            if state["last"] is not None and state["last"] + initial not in _LEGAL:
                state["illegal"] += 1
            state["last"] = initial
        if len(out) >= 4_096:
            yield rows(types)
            out.clear()
    if state is not None:
        close()
    if out:
        yield rows(types)


_FEATURES = ("place", "conv_id", "turn", "initial", "blank", "ended", "digest", "gone")


class Node:
    """A suffix of signatures: per grammar state the cost to go, the first edit, and where it leads."""

    __slots__ = ("cost", "edit", "then")

    def __init__(self, symbol: str | None, rest: Node | None) -> None:
        best = [self._before(symbol, rest, q) for q in range(4)]
        # An insertion leads to another state of the same suffix. Two in a row that
        # come back to a state only cost, so one look ahead settles USER and ASSISTANT.
        settled = list(best)
        for q in (USER, ASSISTANT, SYSTEM, START):
            to = _NEXT[q][1]
            onward = best[to] if q in (USER, ASSISTANT) else settled[to]
            settled[q] = min(best[q], (INSERT + onward[0], "I", None))
        self.cost = [s[0] for s in settled]
        self.edit = [s[1] for s in settled]
        self.then = [
            (self, _NEXT[q][1]) if s[1] == "I" else s[2] for q, s in enumerate(settled)
        ]

    @staticmethod
    def _before(symbol: str | None, rest: Node | None, q: int):
        """The cheapest way to deal with the suffix's first row in state ``q``.

        The edits of a state differ in their letters, so the least letter among the
        cheapest begins the least audit.
        """
        if symbol is None:
            return (0, "", None) if q in (START, ASSISTANT) else (_NEVER, "~", None)
        options = [(DELETE + rest.cost[q], "D", (rest, q))]
        if symbol != _MUST_GO:
            extra = LEFT_TRUNCATED if symbol.isupper() else 0
            role, to = _NEXT[q]
            options.append((REROLE + extra + rest.cost[to], "R", (rest, to)))
            if symbol.lower() == role:
                options.append((extra + rest.cost[to], "K", (rest, to)))
            elif symbol.lower() == "s" and q == START:
                options.append((extra + rest.cost[SYSTEM], "K", (rest, SYSTEM)))
        return min(options, key=lambda o: o[:2])

    def audit(self, state: int = START) -> str:
        node, edits = self, []
        while node.edit[state]:
            edits.append(node.edit[state])
            node, state = node.then[state]
        return "".join(edits)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of distinct signatures that come sorted by their reverse."""
    path, symbols = [Node(None, None)], ""
    for batch in batches:
        audits, costs = [], []
        for signature in batch.column(0).to_pylist():
            backward = signature[::-1]
            shared = 0
            for a, b in zip(symbols, backward, strict=False):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :]
            for symbol in backward[shared:]:
                path.append(Node(symbol, path[-1]))
            symbols = backward
            audits.append(path[-1].audit())
            costs.append(path[-1].cost[START])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["signature", "cost", "audit"],
        )


class _Mending:
    """The digest of a repaired conversation, built as its rows pass."""

    def __init__(self, place: bytes, audit: str) -> None:
        self.place, self.audit, self.at = place, audit, 0
        self.state, self.sha, self.any = START, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any = True

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            initial, self.state = _NEXT[self.state]
            self._put(_ROLES[initial], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        initial, to = _NEXT[self.state]
        if edit == "R":
            role = _ROLES[initial]
        elif self.state == START and role[:1] == "s":
            to = SYSTEM
        self.state = to
        self._put(role, text)

    def digest(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


def _mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests from streams of (audit, then rows) per conversation."""
    names, out, mending = ("place", "repaired_sha256"), [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("place", "audit", "role", "text")]
        for place, audit, role, text in zip(*columns, strict=True):
            if audit is not None:
                if mending is not None:
                    out.append((mending.place, mending.digest()))
                mending = _Mending(place, audit)
            else:
                mending.row(role, text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
            out.clear()
    if mending is not None:
        last = [pa.array([mending.place]), pa.array([mending.digest()])]
        yield pa.RecordBatch.from_arrays(last, names)


def solve_signatures(signatures: DataFrame) -> DataFrame:
    """Rows ``(signature, cost, audit)`` of the distinct values of ``signature``."""
    width = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = stored(signatures.select("signature").distinct(), "repair-signatures")
    ordered = distinct.withColumn("backward", F.reverse("signature"))
    ordered = ordered.repartitionByRange(width, "backward").sortWithinPartitions("backward")
    return ordered.select("signature").mapInArrow(_solve, "signature string, cost long, audit string")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id``: faults of the damaged rows and the cheapest repair.

    Columns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Rows stand by ``turn``, nulls first; rows of one turn stand
    by role and then by a digest of the text. A null role, text or turn counts as one
    space where text is wanted; rows with a null ``conv_id`` are one conversation.
    A conversation without rows has zeros, an empty audit and the digest of nothing.
    Repeated rows are duplicates. Other columns are not read. An empty table gives
    no rows.
    """
    spark = conversations.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = damaged(conversations)
    digest = F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")))
    # A conversation's place in the order; 16 bytes, also for the null id.
    place = F.unhex(F.md5(F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    keyed = rows.withColumns({"digest": digest, "place": place})
    features = keyed.select(
        "place",
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "role",
        F.substring("role", 1, 1).alias("initial"),
        (F.length(trimmed) == 0).alias("blank"),
        F.substring(trimmed, -1, 1).isin(*STOPS).alias("ended"),
        "digest",
        "gone",
    )
    order = ("place", F.asc_nulls_first("turn"), "role", "digest")
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    signed = stored(
        features.repartition(width, "place")
        .sortWithinPartitions(*order)
        .select(*_FEATURES)
        .mapInArrow(
            _signatures,
            f"place binary, conv_id {id_type}, signature string, gaps long, blank long, "
            "duplicate long, truncated long, illegal long",
        ),
        "repair-signed",
    )
    solved = stored(solve_signatures(signed), "repair-solved")
    planned = stored(signed.join(solved, "signature"), "repair-planned")

    none = F.lit(None).cast("string")
    steps = planned.select(
        "place", F.lit(0).alias("step"), F.lit(None).cast("long").alias("turn"), none.alias("role"),
        none.alias("text"), F.lit(None).cast("binary").alias("digest"), "audit",
    ).unionByName(
        keyed.filter(~F.col("gone")).select(
            "place", F.lit(1).alias("step"), F.col("turn").cast("long").alias("turn"), "role",
            "text", "digest", none.alias("audit"),
        )
    )
    mended = (
        steps.repartition(width, "place")
        .sortWithinPartitions("place", "step", F.asc_nulls_first("turn"), "role", "digest")
        .select("place", "audit", "role", "text")
        .mapInArrow(_mend, "place binary, repaired_sha256 string")
    )
    return planned.join(mended, "place").select(
        "conv_id",
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        "audit",
        "repaired_sha256",
    )
