"""Repair and the prefix trie of conversations, against SQL and brute force."""

import hashlib
import itertools
import random
import zlib

import duckdb
import pyarrow as pa
import pytest

from sortilex.llm import conversation_repair, prefix_trie
from sortilex.llm.queries import llm_sql

SCHEMA = "conv_id long, turn long, role string, text string, place string, fp string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def by_sql(df, query):
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    found = con.sql(llm_sql()[query])
    return sorted(map(repr, (dict(zip(found.columns, r, strict=True)) for r in found.fetchall())))


def rows_of(df):
    return sorted(map(repr, (r.asDict() for r in df.collect())))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, ties, repeated rows, gaps, odd roles and a long text and conversation."""
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", None, "Ärger"]
    texts = [None, "", " \n", "yes.", "no", "why?\n", "word " * 20_000, "é…", "yes."]
    rows = []
    for conv in [*range(60), *range(100, 130), 205, 299, 100_007, None]:
        for _ in range(rng.randrange(1, 9)):
            turn = rng.choice([0, 1, 2, 3, 7, None])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rows += [(1, t, "user" if t % 2 else "assistant", f"t{t % 7}.") for t in range(400)]
    rows += [(2, 0, "user", "same.")] * 6
    return conversations(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return conversations(spark, [])


# --- repair --------------------------------------------------------------------


def test_repair_agrees_with_sql_on_odd_rows(odd):
    got = rows_of(conversation_repair.repair_conversations(odd))
    assert got == by_sql(odd, "op12_conversation_repair")
    assert len(got) == odd.select("conv_id").distinct().count()


def test_repair_of_an_empty_table(none):
    assert conversation_repair.repair_conversations(none).collect() == []


def plain_plan(symbols, state=0, inserted=0):
    """The cheapest edits by trying all, with at most two insertions in a row."""
    next_role = {0: "u", 1: "u", 2: "a", 3: "u"}
    after = {"u": 2, "a": 3}
    found = []
    if not symbols and state in (0, 3):
        found.append((0, ""))
    if inserted < 2:
        cost, edits = plain_plan(symbols, after[next_role[state]], inserted + 1)
        found.append((cost + 3, "I" + edits))
    if symbols:
        first, rest = symbols[0], symbols[1:]
        cost, edits = plain_plan(rest, state)
        found.append((cost + 4, "D" + edits))
        if first != "x":
            extra = 3 if first.isupper() else 0
            cost, edits = plain_plan(rest, after[next_role[state]])
            found.append((cost + 3 + extra, "R" + edits))
            if first.lower() == next_role[state]:
                found.append((cost + extra, "K" + edits))
            if first.lower() == "s" and state == 0:
                cost, edits = plain_plan(rest, 1)
                found.append((cost + extra, "K" + edits))
    return min(found, default=(10**9, ""))


def test_every_short_signature_has_its_cheapest_plan():
    letters = "xsSuUaAoO"
    signatures = ["".join(s) for n in range(4) for s in itertools.product(letters, repeat=n)]
    rng = random.Random(3)
    signatures += ["".join(rng.choices(letters, k=6)) for _ in range(60)]
    signatures = sorted(set(signatures), key=lambda s: s[::-1])
    batches = [
        pa.record_batch({"signature": signatures[k : k + 100]}) for k in range(0, len(signatures), 100)
    ]
    solved = [r for b in conversation_repair._solve(batches) for r in b.to_pylist()]
    assert [r["signature"] for r in solved] == signatures
    for r in solved:
        assert (r["cost"], r["audit"]) == plain_plan(r["signature"]), r


def test_a_suffix_is_solved_once(monkeypatch):
    made = []
    real = conversation_repair.Node.__init__

    def counting(self, symbol, rest):
        made.append(symbol)
        real(self, symbol, rest)

    monkeypatch.setattr(conversation_repair.Node, "__init__", counting)
    signatures = sorted({"ua" * n for n in range(50)} | {"s" + "ua" * n for n in range(50)}, key=lambda s: s[::-1])
    list(conversation_repair._solve([pa.record_batch({"signature": signatures})]))
    suffixes = {s[k:] for s in signatures for k in range(len(s) + 1)}
    assert len(made) == len(suffixes)


def test_each_fault_by_hand(spark):
    """Two turns each, the first one hit by fault 0 to 4 or by none, the second by none."""

    def fault(conv, turn):
        return zlib.crc32(f"{conv}:{turn}".encode()) % 20

    conv = {
        f: next(c for c in range(10_000) if min(fault(c, 0), 5) == f and fault(c, 3) > 4) for f in range(6)
    }
    turns = [(0, "assistant", "Hm. Hi!"), (3, "user", "Fine.")]
    rows = conversations(spark, [(c, *t) for c in conv.values() for t in turns])
    got = {r["conv_id"]: r for r in conversation_repair.repair_conversations(rows).collect()}
    want = {  # gaps, blank, duplicate, truncated, illegal, cost, audit, repaired
        0: (0, 0, 0, 0, 0, 3, "KI", "user:Fine.\nassistant:"),
        1: (2, 1, 0, 0, 0, 7, "DKI", "user:Fine.\nassistant:"),
        2: (2, 0, 0, 1, 0, 7, "DKI", "user:Fine.\nassistant:"),
        3: (2, 0, 1, 0, 1, 10, "IKDKI", "user:\nassistant:Hm. Hi!\nuser:Fine.\nassistant:"),
        4: (2, 0, 0, 0, 1, 3, "KR", "user:Hm. Hi!\nassistant:Fine."),
        5: (2, 0, 0, 0, 0, 6, "IKKI", "user:\nassistant:Hm. Hi!\nuser:Fine.\nassistant:"),
    }
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    for f, (*values, repaired) in want.items():
        r = got[conv[f]]
        assert tuple(r[n] for n in names) == tuple(values), (f, r)
        assert r["repaired_sha256"] == hashlib.sha256(repaired.encode()).hexdigest(), f


# --- trie ----------------------------------------------------------------------


def test_trie_agrees_with_sql_on_odd_rows(odd):
    got = rows_of(prefix_trie.prefix_trie(odd))
    assert got == by_sql(odd, "op13_conversation_prefix_trie")


def test_trie_does_not_depend_on_its_batches(odd, monkeypatch):
    whole = rows_of(prefix_trie.prefix_trie(odd))
    monkeypatch.setattr(prefix_trie, "BATCH_CONVERSATIONS", 3)
    assert rows_of(prefix_trie.prefix_trie(odd)) == whole


def test_trie_of_an_empty_table(none):
    assert prefix_trie.prefix_trie(none).collect() == []


def test_trie_of_one_conversation_by_hand(spark):
    rows = [(100, 0, "user", "héllo"), (100, 1, "assistant", "ok"), (200, 0, "user", "héllo")]
    got = {(r["conv_id"], r["depth"]): r for r in prefix_trie.prefix_trie(conversations(spark, rows)).collect()}
    assert sorted(got) == [(100, 0), (100, 1), (100, 2)]
    assert [got[100, d]["n_convs"] for d in range(3)] == [2, 2, 1]
    assert [got[100, d]["n_children"] for d in range(3)] == [1, 1, 0]
    assert [got[100, d]["n_leaves"] for d in range(3)] == [1, 1, 1]
    assert [got[100, d]["saved_tokens"] for d in range(3)] == [5, 5, 0]
    assert [got[100, d]["parent_conv_id"] for d in range(3)] == [None, 100, 100]


