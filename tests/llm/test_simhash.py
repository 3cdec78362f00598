"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from rowrelay.llm import simhash
from rowrelay.llm.components import components
from rowrelay.llm.queries import op3_simhash_near_dedup
from rowrelay.llm.trie import link


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, budget=4):
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= budget:
                up[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, k in enumerate(ids):
        groups.setdefault(root(i), []).append(k)
    return [min((k for k in groups[root(i)] if k is not None), default=None) for i in range(len(ids))]


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    prints = [slow_fingerprint(r.text) for r in docs]
    wanted = sorted((r.doc_id, f"{p:016x}", c) for r, p, c in zip(docs, prints, slow_components([r.doc_id for r in docs], prints)))
    found = op3_simhash_near_dedup(spark, small)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect())) == wanted


def test_edge_rows(spark):
    text = "one two three four five six seven"
    rows = [(5, text, 1), (3, text.upper(), 1), (3, text.upper(), 1), (None, text, 1), (7, None, 1), (8, "", 1), (9, " \n\t", 1), (1, "two words", 1), (2, "x " * 200_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumnRenamed("fp", "component_id")
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    zero = "0" * 16
    assert {(7, zero, 7), (8, zero, 7), (9, zero, 7)} <= found
    assert {k: c for k, _, c in found if k in (None, 3, 5)} == {None: 3, 3: 3, 5: 3}
    assert simhash.near_duplicates(docs).count() == len(rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 2), (False, 3), (False, 7), (True, 0)]


def cloud(n, seed):
    """Random keys, and balls of keys a few bits around some of them."""
    rng = random.Random(seed)
    keys = {rng.getrandbits(64) for _ in range(n)}
    for centre in list(keys)[: n // 20]:
        for _ in range(30):
            keys.add(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 6))) & (2**64 - 1))
    return np.array(sorted(keys), np.uint64)


def roots_of(pairs, n):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in pairs:
        a, b = sorted((root(int(i)), root(int(j))))
        up[b] = a
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("budget", [0, 1, 4])
def test_trie_finds_every_link(budget):
    keys = cloud(400, budget)
    i, j = np.triu_indices(keys.size, 1)
    near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
    assert link(keys, 0, budget).tolist() == roots_of(zip(i[near], j[near]), keys.size)


@pytest.mark.parametrize("part", [1 << 18, 16])
def test_links_keep_components(spark, part):
    """Also when a block value is cut into parts."""
    keys = cloud(300, 9)
    i, j = np.triu_indices(keys.size, 1)
    near = np.bitwise_count(keys[i] ^ keys[j]) <= 4
    names = keys.view(np.int64)
    frame = spark.createDataFrame([(int(k),) for k in names], "fp long")
    edges = simhash.links(frame, part=part).collect()
    where = {int(k): n for n, k in enumerate(names)}
    assert roots_of([(where[a], where[b]) for a, b in edges], keys.size) == roots_of(zip(i[near], j[near]), keys.size)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(5000, 5000 - i) for i in range(50)] + [(7, 7), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a int, b int")).collect()))
    real = [(a, b) for a, b in edges if a is not None and a != b]
    roots = roots_of(real, 5001)
    assert found == {v: roots[v] for e in real for v in e}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_components_of_a_path(spark, monkeypatch):
    """Nodes in the order of the path: rounds grow with the logarithm of its length."""
    from rowrelay.llm import components as module

    names = []
    monkeypatch.setattr(module, "saved", lambda frame, name: (names.append(name), frame.sparkSession.createDataFrame(frame.collect(), frame.schema))[1])
    edges = spark.createDataFrame([(i, i + 1) for i in range(1000)], "a long, b long")
    found = dict(map(tuple, components(edges).collect()))
    assert found == dict.fromkeys(range(1001), 0)
    assert names.count("step") <= 25
