"""Benchmark decontamination against a plain search."""

import random
import re

from rowrelay.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(text, items, size=10):
    own = words(text)
    hit, found = set(), set()
    for item, other in items:
        theirs = words(other)
        n = min(size, len(theirs))
        wins = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(item) if item is not None else "")
    return len(own), len(hit), sorted(found)


def run(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string, n_words string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return decontaminate.contamination(docs, items)


def test_against_plain_search(spark):
    """Few different words, so that windows overlap, repeat and share shingles."""
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["ab", "Cd", "éf", "x9"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 4, 5, 9, 10, 11, 14]))) for i in range(30)]
    docs = [(i, text(rng.randrange(0, 120)), "") for i in range(60)]
    docs += [(100 + i, "Start, " + t.upper() + "; end" if t else None, "") for i, t in items if t]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in run(spark, docs, items).collect()}
    assert got == {i: slow(t, items) for i, t, _ in docs}
    assert any(v[1] for v in got.values())


def test_edge_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    items = [(1, passage), (1, "alpha beta gamma"), (2, passage), (None, passage), (3, None), (4, ""), (5, "...")]
    docs = [(1, "x " * 50_000 + passage, ""), (1, "x " * 50_000 + passage, ""), (None, passage, ""), (2, None, ""), (3, "", ""), (4, "One-two THREE four_five six seven eight nine ten", ""), (1, "alpha beta gamma", "")]
    got = sorted(((r.doc_id or 0), r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in run(spark, docs, items).collect())
    every = ["", "1", "2"]
    assert got == sorted([(1, 50_011, 11, 3, every, True)] * 2 + [(0, 11, 11, 3, every, True), (2, 0, 0, 0, [], False), (3, 0, 0, 0, [], False), (4, 10, 10, 3, every, True), (1, 3, 3, 1, ["1"], True)])
    assert run(spark, [], items).count() == 0
    assert run(spark, docs, []).where("contaminated").count() == 0


def test_a_small_filter_loses_nothing(spark):
    """A filter that lets nearly all shingles through gives the same result."""
    items = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 12))) for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 30))) for i in range(0, 60, 7)], "doc_id long, text string")
    rows = [sorted(map(str, decontaminate.contamination(docs, items, filter_bits=b).collect())) for b in (6, 24)]
    assert rows[0] == rows[1]


def test_clean_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", "s"), (2, "fine", "s"), (None, "a b c d e f g h i j", "s")], "doc_id long, text string, source string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2]


def test_clean_decides_each_text(spark):
    """Rows without an id, and texts that share one, are decided by their own text."""
    passage = "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, passage), (1, "fine"), (None, passage + " k"), (None, "fine too"), (None, None), (2, "fine"), (2, "fine")], "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontaminate.clean(docs, items, by_text=True)
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [(1, "fine"), (None, "fine too"), (None, None), (2, "fine"), (2, "fine")]))
