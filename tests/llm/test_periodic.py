"""Runs and common extensions against brute force."""

import hashlib
import random
import zlib

import numpy as np

from rowrelay.llm import periodic
from rowrelay.llm.lce import Extensions
from rowrelay.llm.queries import op13_periodic_runs, planted_runs


def slow_runs(words):
    """(start, length, period) by trying every period at every place."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def slow_collapsed(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_extensions():
    rng = np.random.default_rng(5)
    for size, kinds in ((1, 1), (14, 1), (60, 2), (700, 2), (700, 30), (3000, 1)):
        words = np.append(rng.integers(0, kinds, size), [kinds])
        if size > 100:
            words[size // 2 : size // 2 + 40] = words[10:50]
        longest = Extensions(words)
        i, j = rng.integers(0, size + 1, (2, 500))
        i, j = i[i != j], j[i != j]
        found = longest(i, j)
        for a, b, n in zip(i, j, found, strict=True):
            assert (words[a : a + n] == words[b : b + n]).all()
            assert max(a, b) + n == words.size or words[a + n] != words[b + n]


def test_runs(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "a", "a a a a a", "a a a a a a", "A a a a a a a", "a b " * 4, "  é " * 7, "x " * 5000 + "end"]
    for _ in range(200):
        words = [str(rng.randrange(rng.choice([1, 2, 3, 60]))) for _ in range(rng.choice([7, 30, 100, 300]))]
        if rng.random() < 0.6:
            a, p = rng.randrange(len(words)), rng.randrange(1, len(words) // 4 + 1)
            words[a:] = [words[a + i % p] for i in range(len(words) - a)]
        texts.append(rng.choice([" ", "\n", "  \t"]).join(words))
    docs = spark.createDataFrame([(None if k % 50 == 3 else k // 2, t, k) for k, t in enumerate(texts)], "`doc.id` long, text string, runs long")
    found = periodic.strongest(periodic.runs(docs, "doc.id")).collect()
    assert len(found) == len(texts)
    for text, row in zip(texts, found, strict=True):
        words = words_of(text)
        wanted = slow_runs(words) if len(words) < 1000 else [(0, 5000, 1)]
        assert [tuple(r) for r in row.runs] == wanted and row.n_words == len(words)
        assert row.collapsed == slow_collapsed(words, wanted)
        best = min(wanted, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert (tuple(row.best) if row.best else None) == best
    assert periodic.runs(docs.limit(0), "doc.id").count() == 0


def test_chunks_and_grid_steps(monkeypatch):
    """The same runs whatever is looked at together."""
    texts = [[b"a", b"b", b"c"] * 20, [b"x"] * 50, [], [b"q%d" % i for i in range(90)]]
    wanted = list(periodic._found(texts))
    monkeypatch.setattr(periodic, "_PLACES", 5)
    assert list(periodic._found(texts)) == wanted
    assert [x for t in texts for x in periodic._found([t])] == wanted


def test_query(spark, small):
    docs = {r.doc_id: words_of(r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    planted = {r.doc_id: r.text for r in planted_runs(spark.read.parquet(f"{small}/documents.parquet")).collect()}
    found = {r.doc_id: r for r in op13_periodic_runs(spark, small).collect()}
    assert found.keys() == docs.keys() == planted.keys()
    with_runs = 0
    for k, words in docs.items():
        h = zlib.crc32(str(k).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        assert words_of(planted[k]) == words
        runs, row = slow_runs(words) if n < 3000 else None, found[k]
        if runs is None:
            continue
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(slow_collapsed(words, runs).encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs >= 5
