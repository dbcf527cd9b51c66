"""SimHash components, against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from sortilex.llm import simhash_vp
from sortilex.llm.components import connected_components
from sortilex.llm.store import stored

SCHEMA = "doc_id long, text string, fp string, tree long, least long"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Least index that each index reaches over links of at most four bits."""
    least = list(range(len(fps)))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 4) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            least[b] = a
    return [find(i) for i in range(len(fps))]


def clustered(n, seed, flips):
    """Fingerprints in clusters, so that links lie within, beside and across shards."""
    rng = np.random.default_rng(seed)
    centers = rng.integers(0, 2**64, n // 12, dtype=np.uint64)
    fps = centers[rng.integers(0, len(centers), n)]
    for _ in range(flips):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
    return np.unique(fps)


@pytest.mark.parametrize("flips", [2, 4, 7])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, flips):
    monkeypatch.setattr(simhash_vp, "SHARD", 40)
    monkeypatch.setattr(simhash_vp, "CHUNK", 30)
    monkeypatch.setattr(simhash_vp, "VISITORS", 25)
    monkeypatch.setattr(simhash_vp, "_FEW", 50)
    fps = clustered(1_500, flips, flips)
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = simhash_vp.fingerprint_links(table, len(fps))
    found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    want = plain_components(fps)
    groups = {}
    for i, root in enumerate(want):
        groups.setdefault(root, set()).add(int(fps[i].view(np.int64)))
    got = {}
    for x in fps.view(np.int64).tolist():
        got.setdefault(found.get(x, x), set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))
    assert len(groups) < len(fps)


def test_a_dense_shard_is_cut_into_chunks(spark, monkeypatch):
    """All fingerprints share a third of their bits, so no tree on it can split them."""
    monkeypatch.setattr(simhash_vp, "SHARD", 32)
    monkeypatch.setattr(simhash_vp, "CHUNK", 50)
    monkeypatch.setattr(simhash_vp, "VISITORS", 60)
    rng = np.random.default_rng(4)
    low = np.zeros(800, np.uint64)
    for _ in range(5):
        low ^= np.uint64(1) << rng.integers(0, 22, 800, dtype=np.uint64)
    fps = np.unique(np.concatenate([low, low[:200] ^ np.uint64(1 << 63 | 1 << 50 | 1 << 40)]))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = connected_components(simhash_vp.fingerprint_links(table, len(fps))).collect()
    component = {r["node"]: r["component"] for r in found}
    want = plain_components(fps)
    got = [component.get(int(x), int(x)) for x in fps.view(np.int64)]
    assert len(set(zip(got, want, strict=True))) == len(set(want)) == len(set(got))


def test_a_tree_has_one_home_per_fingerprint_and_prunes():
    fps = clustered(4_000, 1, 3)
    tree = simhash_vp.build_tree(fps[::3], simhash_vp.BLOCKS[0], 64)
    row, shard, home = tree.route(fps)
    assert sorted(row[home].tolist()) == list(range(len(fps)))
    assert shard.max() < 64 and len(np.unique(shard[home])) > 40
    assert len(row) < 8 * len(fps)


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    rows = [
        (5, None), (3, ""), (9, " \n\t"), (1, "one"), (2, "ONE"), (2, "two words"), (None, "one"),
        (20, long), (21, long + " end"), (22, "a b c d"), (22, "a b c d"), (30, "ÀB é\x0bc\x85d"),
    ]
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def test_odd_rows(odd):
    rows = simhash_vp.simhash_components(odd).collect()
    texts = {(r["doc_id"], r["text"]) for r in odd.collect()}
    assert len(rows) == 12
    assert sorted(r["fingerprint"] for r in rows) == sorted(
        f"{plain_fingerprint(r['text']):016x}" for r in odd.collect()
    )
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by[5] == by[3] == by[9] == {3}
    assert by[1] == by[None] == {1} and by[20] == by[21] == {20}
    assert by[2] == {1, 2} and len(texts) == 11


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_vp.simhash_components(empty).collect() == []


def test_fingerprints_link_as_all_pairs_do_on_documents(spark):
    documents = stored(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "docs")
    got = {r["doc_id"]: r for r in simhash_vp.simhash_components(documents).collect()}
    rows = sorted((r["doc_id"], plain_fingerprint(r["text"])) for r in documents.collect())
    fps = np.array([f for _, f in rows], np.uint64)
    for (doc_id, fp), root in zip(rows, plain_components(fps), strict=True):
        assert got[doc_id]["fingerprint"] == f"{fp:016x}"
        assert got[doc_id]["component_id"] == rows[root][0]
