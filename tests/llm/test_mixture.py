"""Mixing against plain water filling and a plain prefix sum."""

import random
from collections import defaultdict

import pytest

from rowrelay.llm import mixture


def slow_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        share = (left - sum(2 * sizes[s] for s in full)) / max(1, sum(weights[s] for s in free))
        above = [s for s in free if share * weights[s] > 2 * sizes[s]]
        if not above:
            return {s: 2.0 * sizes[s] if s in full else share * weights[s] for s in names}
        full |= set(above)


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_mix(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", "é", "z\U0001f600", "Z", "", None, "￿"]
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choice(names[: rng.choice([2, 8])]), "x") for i in range(500)]
    rows += [(1000 + i, "hot " * 20, "hot", "x") for i in range(400)]
    found = mixture.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, size string")).collect()
    sizes, taken, goal = defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        goal[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert goal == {s: pytest.approx(t, abs=1e-5) for s, t in slow_targets(sizes).items()}
    assert {r.source: r.source_size for r in found} == dict(sizes)
    assert taken == {s: int(t) for s, t in goal.items()}
    for s in sizes:  # whole epochs come first; then a prefix, with one document that is cut
        epochs = int(goal[s] // sizes[s]) if sizes[s] else 0
        extra = [r.taken - epochs * r.size for r in found if r.source == s]
        assert sum(0 < e < r.size for e, r in zip(extra, [r for r in found if r.source == s])) <= 1


def test_edge_rows(spark):
    rows = [(None, "a b", None), (1, None, "s"), (1, "", "s"), (1, "a b c", "s"), (1, "a b c", "s"), (2, "x " * 200_000, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = sorted(map(str, mixture.mix(docs).collect()))
    assert first == sorted(map(str, mixture.mix(docs.repartition(3)).collect()))
    assert len(first) == len(rows)
    assert mixture.mix(docs.limit(0)).count() == 0
    only = mixture.mix(spark.createDataFrame([(1, None, "s"), (2, " ", None)], docs.schema)).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2


def test_weights_favour_documents(spark):
    """The chance of a place among the first grows with the weight."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a b c d e' AS text", "CASE WHEN id % 2 = 0 THEN 'h' ELSE 'l' END AS lang", "'s' AS source")
    from pyspark.sql import functions as F

    mixed = mixture.mix(docs, weight=F.when(docs.lang == "h", 9.0).otherwise(1.0), share=0.5).collect()
    heavy = sum(r.taken for r in mixed if r.doc_id % 2 == 0)
    assert heavy > 0.75 * sum(r.taken for r in mixed)


def test_running(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(40), rng.randrange(10)) for _ in range(600)]
    frame = spark.createDataFrame(rows, "g string, o int, v int").withColumn("n", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1))
    found = mixture.running(frame, ["g"], ["o", "v"], {"before": "v", "rank": "n"}).collect()
    for g in "ab":
        total = 0
        for i, r in enumerate(sorted((r for r in found if r.g == g), key=lambda r: r["rank"])):
            assert (r["rank"], r.before) == (i, total)
            total += r.v
    assert [(r.o, r.v) for r in sorted((r for r in found if r.g == "a"), key=lambda r: r["rank"])] == sorted((o, v) for g, o, v in rows if g == "a")
