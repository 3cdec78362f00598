"""Licence scan against plain Python."""

import random
import re
from collections import Counter

import pytest

from rowrelay.llm import licenses


def slow(text, templates, least=licenses.LEAST):
    plain = re.sub(r"[^a-z0-9\n]+", " ", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    flat = lambda x: re.sub(r"[ \n]+", " ", x).strip(" ")
    parts = {x.strip(" ") for x in plain.split("\n")} | {flat(x) for x in re.split("\n *\n", plain) if "\n" in x} | {flat(plain)}
    grams = lambda words: Counter(zip(words, words[1:]))
    known = set().union(*(grams(licenses.words_of(w)) for w in templates.values()))
    stretch = []
    for line in [x.split() for x in plain.split("\n") if x.strip(" ")] + [[]]:
        own = grams(line)
        if own and 2 * sum(n for g, n in own.items() if g in known) >= sum(own.values()):
            stretch += line
        else:
            parts.add(" ".join(stretch))
            stretch = []
    compared, found, ratio = set(), [], least / (2 - least)
    for part in parts:
        own = grams(part.split())
        n = sum(own.values())
        for name, wording in templates.items():
            theirs = grams(licenses.words_of(wording))
            m = sum(theirs.values())
            if n and min(n, m) >= ratio * max(n, m):
                compared.add(part)
                dice = round(2 * sum((own & theirs).values()) / (n + m), 6)
                if dice >= least:
                    found.append((name, dice, part))
    return len(compared), sorted(found)


def run(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string, units string")
    return [(r.doc_id, r.n_units, [tuple(m) for m in r.matches]) for r in licenses.scan(docs, **more).collect()]


def test_against_plain_python(spark):
    rng = random.Random(4)
    small = {"one": "a b a b c", "two": "b a b a", "three": "c c c c c c c", "none": "a"}
    text = lambda: "".join(rng.choice(["a ", "B, ", "c ", "\n", "\n\n", "é"]) for _ in range(rng.randrange(0, 60)))
    rows = [(i, text(), "") for i in range(150)]
    assert run(spark, rows, templates=small) == [(k, *slow(t, small)) for k, t, _ in rows]


def test_wordings(spark):
    wrapped = "\n".join(licenses.TEMPLATES["MIT-text"].split(", "))
    rows = [(1, "Text.\nReleased under the MIT License.\nMore text here.", ""), (2, f"Intro\n\n{wrapped}\n\nEnd", ""), (3, "licensed UNDER cc-by-nc 4.0!", ""), (4, "Licensed under CC BY 4.0", ""), (5, None, ""), (5, "", ""), (None, "\n \n", ""), (6, "word " * 200_000, ""), (6, "word " * 200_000, "")]
    found = run(spark, rows)
    assert found == [(k, *slow(t, licenses.TEMPLATES)) for k, t, _ in rows]
    names = {k: [m[0] for m in ms] for k, _, ms in found}
    assert (names[1], names[2], names[3], names[6]) == (["MIT"], ["MIT-text"] * 2, ["CC-BY-NC-4.0"], [])
    assert run(spark, rows[:0] or [(1, None, "")])[0][1:] == (0, [])
    assert spark.createDataFrame([], "doc_id long, text string").transform(licenses.scan).count() == 0
    with pytest.raises(ValueError):
        run(spark, rows, templates={"x": "one"})


def test_a_wrapped_licence_between_other_lines(spark):
    """Code on the lines around it, a comment sign before each line, a blank line in it."""
    def wrapped(name, width):
        words = licenses.TEMPLATES[name].split()
        return [" ".join(words[i : i + width]) for i in range(0, len(words), width)]

    code = ["import numpy as np", "def f(x): return x + 1", "print(f(np.ones(3)))"]
    rows = []
    for i, name in enumerate(sorted(licenses.TEMPLATES)):
        body = wrapped(name, 9)
        body.insert(len(body) // 2, "")
        rows.append((i, "\n".join([*code, *(f"# {x}" for x in body), *code]), ""))
    found = run(spark, rows)
    assert found == [(k, *slow(t, licenses.TEMPLATES)) for k, t, _ in rows]
    for name, (_, _, matches) in zip(sorted(licenses.TEMPLATES), found):
        if len(licenses.words_of(licenses.TEMPLATES[name])) >= 10:
            assert name in [m[0] for m in matches], name


def test_no_shuffle_no_python(spark, small):
    plan = licenses.scan(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
