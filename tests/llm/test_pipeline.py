"""The pipeline, stage by stage, against plain Python over what the stage before kept."""

from collections import defaultdict

from test_decontaminate import slow as slow_windows
from test_mixture import slow_targets
from test_nearcopies import slow_pairs
from test_secrets import slow_base
from test_simhash import roots_of

import corpus_pipeline
from rowrelay.llm import cotraining, secrets
from rowrelay.llm.queries import quality_labels


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], small).cache())
    raw, good, apart, clean, masked, mix = map(rows_of, steps)
    assert [s.columns for s in steps[:5]] == [docs.columns] * 5

    kept = {r.doc_id for r in cotraining.classified(docs, quality_labels(spark, small)).collect() if r.kept}
    assert good == {k: r for k, r in raw.items() if k in kept}
    assert 0.8 * len(raw) < len(good) < len(raw)

    ids = sorted(good)
    roots = roots_of(slow_pairs([good[k].text for k in ids]), len(ids))
    assert apart == {k: good[k] for i, k in enumerate(ids) if roots[i] == i}

    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert clean == {k: r for k, r in apart.items() if not slow_windows(r.text, items)[1]}
    assert len(clean) < len(apart)

    assert masked.keys() == clean.keys()
    for k, r in masked.items():
        spans = [tuple(map(int, s.split(":")[1:])) for s in slow_base(clean[k].text)[2].split(",") if s]
        assert not slow_base(r.text)[2]
        assert r.text == secrets.masked(clean[k].text, spans) or secrets.MASK in r.text
        assert r.n_chars == (len(r.text) if r.text != clean[k].text else clean[k].n_chars)

    sizes = defaultdict(int)
    words = {k: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", r.text) if w]) for k, r in masked.items()}
    for k, r in masked.items():
        sizes[r.source] += words[k]
    taken = defaultdict(int)
    for k, r in mix.items():
        assert r[: len(docs.columns)] == masked[k]  # the cleaned text, masks included
        assert r.size == words[k] and 0 < r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert taken == {s: int(t) for s, t in slow_targets(dict(sizes)).items()}


def test_run_is_all_stages(spark, small):
    one = sorted(map(tuple, corpus_pipeline.run(spark, small).collect()))
    assert one == sorted(map(tuple, corpus_pipeline.run(spark, small).collect()))
    assert one


def test_empty_and_null_rows(spark, small):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (2, " ".join(map(str, range(300))), None, None, None), (2, " ".join(map(str, range(300))), None, None, None)]
    for given in ([], rows):
        docs = spark.createDataFrame(given, kind)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small)
        assert docs.count() <= len(given)
