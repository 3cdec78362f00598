"""One-bit codes: the estimate's bound, and the search against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowrelay.llm import onebit
from rowrelay.llm.queries import op11_onebit_neighbours


def slow_nearest(rows, k=20):
    """{(query row, query id): [(score, id)]}; rows are different (id, vector) pairs."""
    usable = [(i, v) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    usable = list(dict.fromkeys((i, tuple(v)) for i, v in usable))
    out = []
    for i, v in usable:
        if i % 20 == 0:
            scores = sorted((-math.fsum(a * b for a, b in zip(v, w)), j) for j, w in usable if (j, w) != (i, v))
            out.append((i, [(-s, j) for s, j in scores[:k]]))
    return sorted(out)


def lists_of(found):
    by = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(by[r.query_id])
    return sorted(by.items())


def same(found, wanted):
    assert [i for i, _ in found] == [i for i, own in wanted if own]
    for (_, mine), (_, own) in zip(found, [w for w in wanted if w[1]], strict=True):
        assert [j for _, j in mine] == [j for _, j in own]
        assert [s for s, _ in mine] == pytest.approx([s for s, _ in own], rel=1e-12, abs=1e-12)


def nearest(spark, rows, kind="array<double>", k=20):
    frame = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], f"vec_id long, embedding {kind}, ids string, score double")
    return onebit.nearest(frame.repartition(3), F.col("vec_id") % 20 == 0, k).collect()


def test_bound_holds():
    rng = np.random.default_rng(1)
    for centre in (np.zeros(64), rng.standard_normal(64)):
        x, q = rng.standard_normal((3000, 64)) + centre, rng.standard_normal((40, 64))
        q /= np.linalg.norm(q, axis=1)[:, None]
        bits, factor, bound = onebit.encoded(x, centre)
        assert bits.shape == (3000, 32)
        signs = np.unpackbits(bits, axis=1) * 2.0 - 1
        near = (q @ onebit.rotation(64).T) @ signs.T * factor + (q @ centre)[:, None]
        assert (np.abs(near - q @ x.T) <= bound).mean() > 0.9995
        assert bound.mean() < 0.3 * np.linalg.norm(x - centre, axis=1).mean()


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    same(lists_of(op11_onebit_neighbours(spark, "/root/testdata/sf0.01").collect()), slow_nearest(rows))


def test_recall():
    """Many rows in several steps, with one limit carried from step to step."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((20000, 32)).astype(np.float32).astype(float)
    x[5000:6000] = x[7] + rng.standard_normal((1000, 32)) / 50  # near copies
    ids, centre = np.arange(20000), np.round(x.mean(axis=0), 3)
    ask, row, score = onebit.search(x, ids, onebit.encoded(x, centre), x[::400], centre, 21)
    exact = x[::400] @ x.T
    hits = [set(row[ask == i]) & set(np.argsort(-exact[i])[:21]) for i in range(50)]
    assert sum(map(len, hits)) >= 0.99 * 50 * 21
    assert score == pytest.approx(exact[ask, row])


def test_shared_limits(monkeypatch):
    """A limit from a sample loses no neighbour, and a block adds up few products although it is a small part."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((24000, 64)).astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[9] = x[20]  # a tie at the limit's side
    ids, centre, q = np.arange(24000), np.round(x.mean(axis=0), 3), x[::400]
    codes = onebit.encoded(x, centre)
    some = rng.permutation(24000)[:8000]
    limits = onebit.first_limits(x[some], [c[some] for c in codes], q, centre, 21)
    exact = q @ x.T
    assert limits == pytest.approx(-np.sort(-exact[:, some], axis=1)[:, 20])
    added, products = [], onebit.products
    monkeypatch.setattr(onebit, "products", lambda x, y, i, j: added.append(i.size) or products(x, y, i, j))
    found = []
    for b in range(16):
        own = np.arange(b, 24000, 16)
        ask, row, score = onebit.search(x[own], ids[own], [c[own] for c in codes], q, centre, 21, limits)
        found += zip(ask.tolist(), (-score).tolist(), own[row].tolist())
    got = [[j for a, _, j in sorted(found) if a == i][:21] for i in range(60)]
    hits = sum(len(set(g) & set(np.argsort(-exact[i], kind="stable")[:21])) for i, g in enumerate(got))
    assert hits >= 0.999 * 60 * 21
    assert sum(added) < 0.05 * 60 * 24000
    assert np.isneginf(onebit.first_limits(x[:20], [c[:20] for c in codes], q, centre, 21)).all()


def test_copies_and_ties(spark):
    """Many copies of a vector: the smallest ids win, a query is not its own neighbour; equal scores tie."""
    hot, side = [0.6, 0.8, 0.0], [0.8, 0.6, 0.0]
    rows = [(i, hot) for i in range(150)] + [(i, side) for i in range(200, 230)] + [(500 + i, [0.0, 0.0, float(i % 3)]) for i in range(30)]
    rows += rows[:60] + [(41, [1.0, 1.0, 1.0]), (3, [0.0, 5.0, 0.0])]  # repeated rows, and ids on two vectors
    same(lists_of(nearest(spark, rows)), slow_nearest(rows))
    twice = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 3.0])]  # an id with two lists
    found = sorted((r.rank, r.vec_id, r.score) for r in nearest(spark, twice))
    assert found == sorted((k + 1, j, s) for _, own in slow_nearest(twice) for k, (s, j) in enumerate(own))


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [2.0]), (1, [0.5, -1.0, 3.0]), (2, [-0.0, 1.0]), (3, [0.0, 1.0])]
    odd = [(None, [1.0, 1.0]), (40, None), (60, []), (80, [0.0, -0.0]), (100, [1.0, None]), (120, [math.nan, 1.0]), (140, [math.inf, 1.0])]
    filled = [(i, [*v, 0.0, 0.0][:3] if v else v) for i, v in rows]
    same(lists_of(nearest(spark, rows + odd)), slow_nearest(filled))
    same(lists_of(nearest(spark, rows + odd, "array<float>")), slow_nearest(filled))
    big = [(i, [c * s for c in (1.0 + i, 2.0, -i)]) for i, s in ((0, 1e150), (1, 1e150), (2, 1e-150), (20, 1.0))]
    same(lists_of(nearest(spark, big)), slow_nearest(big))
    assert nearest(spark, odd) == [] and nearest(spark, []) == [] and nearest(spark, [(20, [1.0])]) == []
