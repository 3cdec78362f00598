"""The divergence audit against sums over every kept term of every pair."""

import random
from collections import Counter, defaultdict

import pyarrow as pa

from rowrelay.llm import divergence


def terms_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if ord(c) >= 128 or "a" <= c.lower() <= "z" and c.isascii():
            word += c.lower() if c.isascii() else c
        elif word:
            out.append(word)
            word = ""
    return out


def slow_audit(rows, least=10):
    docs, count = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang or "", source or "") for _, lang, source in rows})
    for text, lang, source in rows:
        found = Counter(terms_of(text))
        docs[lang or ""].update(found.keys())
        count[lang or "", source or ""].update(found)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        peers = [g[1] for g in groups if g[0] == lang]

        def shares(n):
            total = sum(n[t] for t in kept)
            return [1 + 10**9 * (n[t] + 2) // (total + 2 * len(kept)) for t in kept]

        whole = Counter()
        for s in peers:
            whole.update(count[lang, s])
        p, q = {s: shares(count[lang, s]) for s in peers}, shares(whole)

        def gap(x, y):
            return (x - y) ** 2 // (x + y)

        for s in peers:
            pairs = sorted((-sum(map(gap, p[s], p[o])), o.encode(), o) for o in peers if o != s)
            out |= {(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)}
            own = sorted((-gap(x, y), t.encode(), t) for t, x, y in zip(kept, p[s], q, strict=True) if count[lang, s][t] and x > y)
            out |= {(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(own[:10])}
    return out


def drawn(seed, n):
    rng = random.Random(seed)
    words = ["The", "of", "été", "don't", "x1y", "ÀB", "zz", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(None, None, None), ("", "en", "none"), ("only-here", "xx", "a"), ("only-here", "xx", "b"), ("the", "", "ß")]
    for _ in range(n):
        own = words[: rng.randrange(1, len(words))]
        text = " ".join(rng.choices(own, range(len(own), 0, -1), k=rng.randrange(40)))
        rows.append((text, rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "hot", "a", "B", "é", None])))
    return rows


def test_audit(spark):
    """Null and other columns are fine; repeated rows count twice."""
    rows = drawn(1, 300)
    rows += rows[:40]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n long").repartition(5)
    assert set(map(tuple, divergence.audit(docs).collect())) == slow_audit(rows)


def summed(batches):
    total = Counter()
    for batch in batches:
        for *key, x, y in zip(*batch.to_pydict().values(), strict=True):
            # of counts: n and docs; of sums: a pair's second source belongs to the key
            key, some = (tuple(key), (("n", x), ("docs", y))) if len(batch.schema) == 5 else ((*key, x), (("value", y),))
            for name, value in some:
                total[key, name] += value
    return {k: v for k, v in total.items() if v}


def test_memory_limits(monkeypatch):
    """The same sums where memory is full after every few terms, cells and postings."""
    rows = drawn(2, 200)
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*[[x or "" for x in r] for r in rows[i : i + 60]], strict=True)], names=["t", "l", "s"]) for i in range(0, len(rows), 60)]
    rng = random.Random(4)
    postings = [[{"who": w, "p": rng.randrange(10**6, 10**9), "p0": 10**5 + w} for w in rng.sample(range(9), rng.randrange(1, 9))] for _ in range(300)]
    kind = pa.list_(pa.struct([("who", pa.int64()), ("p", pa.int64()), ("p0", pa.int64())]))
    index = [pa.RecordBatch.from_arrays([pa.array([rng.choice("ab") for _ in range(100)]), pa.array(postings[i : i + 100], kind)], names=["l", "p"]) for i in (0, 100, 200)]
    counted, met = summed(divergence._count(batches)), summed(divergence._partial_sums(index))
    for name, value in {"_HELD": 3, "_CELLS": 2, "_SCATTER": 4}.items():
        monkeypatch.setattr(divergence, name, value)
    assert summed(divergence._count(batches)) == counted and len(counted) > 100
    assert summed(divergence._partial_sums(index)) == met and len(met) > 50


def test_empty(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(docs).count() == 0
    one = spark.createDataFrame([(None, None, None)], docs.schema)
    assert divergence.audit(one).count() == 0
    two = spark.createDataFrame([("a", "en", "x"), (None, "en", None)], docs.schema)
    assert sorted(map(tuple, divergence.audit(two).collect())) == [("en", "", "pair", "x", 0, 1), ("en", "x", "pair", "", 0, 1)]


def test_shares_past_a_long(spark):
    """10**9 occurrences times 10**9 pass 64 bits; the share doesn't."""
    frame = spark.createDataFrame([(10**15 + 7, 3 * 10**15, 11)], "n long, total long, kept long")
    found = frame.select(divergence.share(*map(frame.__getitem__, ("n", "total", "kept"))).alias("p")).first().p
    assert found == 1 + 10**9 * (10**15 + 9) // (3 * 10**15 + 22)
