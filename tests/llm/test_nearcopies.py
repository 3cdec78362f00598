"""Near copies of the pipeline's stage against brute force over all pairs."""

import random

import numpy as np

import corpus_pipeline
from rowrelay.llm import nearcopies, simhash
from test_simhash import roots_of


def slow_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def slow_pairs(texts):
    sets = [slow_set(t) for t in texts]
    every = ((i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)))
    return [(i, j) for i, j in every if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]


def test_stage_leaves_no_near_copy(spark):
    """On the given documents; pairs of 0.8 to 1 differ in more bits than op3 links."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 500")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    roots = roots_of(slow_pairs([r.text for r in rows]), len(rows))
    left = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect())) == sorted(tuple(r) for i, r in enumerate(rows) if roots[i] == i)


def copies(seed, n, words):
    """Texts with one word replaced somewhere; of 120 words all are similar, of 60 only some are."""
    rng = random.Random(seed)
    base = [f"b{seed}w{i}" for i in range(words)]
    for i in range(n):
        own = list(base)
        own[rng.randrange(words)] = f"x{i}"
        yield " ".join(own)


def variants(seed, n, words, edits):
    """A text and others that differ from it in some words each: similar to it, and not all to each other."""
    rng = random.Random(seed)
    base = [f"v{seed}w{i}" for i in range(words)]
    yield " ".join(base)
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(0, words, 6), edits):
            own[at] = f"y{i}p{at}"
        yield " ".join(own)


def strangers(seed, n):
    return [" ".join(f"s{seed}o{i}n{j}" for j in range(50 + i % 7)) for i in range(n)]


def one_bucket(spark, texts):
    """Links and compared pairs of texts that all share one bucket."""
    docs = spark.createDataFrame(list(enumerate(texts)), "code long, text string")
    found = [nearcopies.shingles(t.encode()) for t in texts]
    shared = [(0, i, own.size, *nearcopies.bands(own)[0, 1:].tolist()) for i, own in enumerate(found)]
    shared = spark.createDataFrame(shared, "bucket long, code long, n long, order0 long, order1 long, order2 long")
    needed = spark.createDataFrame([(i, (-1, (False, i, i))) for i in range(len(texts))], "code long, rank struct<met:long,key:struct<none:boolean,id:long,of:long>>")
    roots, checked = nearcopies._links(shared, needed, docs, 5, 0.8)
    return {r.node: r.root for r in roots.collect()}, checked.collect()


def test_compared_pairs_grow_with_the_classes(spark):
    """Unlike texts of one size that share a bucket: no links, and no pairs but with leaders and neighbours."""
    for n in (100, 200, 400):
        texts = [" ".join(f"s{i}n{j}" for j in range(50)) for i in range(n)]
        roots, checked = one_bucket(spark, texts)
        assert not roots and n <= len(checked) <= 2 * nearcopies.ORDERS * n
        assert len({(r.a, r.b) for r in checked}) == len(checked)


def test_strangers_change_nothing(spark):
    """A~B and B~C, but not A~C, by themselves and with strangers of their size in the bucket."""
    words = [f"w{i}" for i in range(120)]
    chain = [" ".join(["x"] * k + words[k:]) for k in (0, 12, 24)]
    assert slow_pairs(chain) == [(0, 1), (1, 2)]
    for more in ([], strangers(1, 14), [" ".join(f"t{i}n{j}" for j in range(110)) for i in range(60)]):
        assert one_bucket(spark, chain + more)[0] == {0: 0, 1: 0, 2: 0}


def test_groups_of_every_size(spark):
    """Removed documents against all pairs: copies, variants of one text, chains, and strangers."""
    groups = {f"copies {n}": list(copies(n, n, 120)) for n in (2, 3, 17, 60)}
    groups |= {f"variants {n}": list(variants(n, n, 200, 3)) for n in (1, 5, 40, 250)}
    chain = [f"c{i}" for i in range(150)]
    groups["chain"] = [" ".join(["z"] * k + chain[k:]) for k in range(0, 80, 10)]
    texts = [t for own in groups.values() for t in own]
    random.Random(9).shuffle(texts)
    texts += strangers(3, 50)
    truth = {i for i, r in enumerate(roots_of(slow_pairs(texts), len(texts))) if r != i}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id for r in nearcopies.deduplicated(docs).collect()}
    gone = set(range(len(texts))) - left
    assert set(range(len(texts) - 50, len(texts))) <= left
    assert gone <= truth and len(gone) >= 0.97 * len(truth), (len(gone), len(truth))


def test_null_and_tied_ids(spark):
    """Rows are told apart by id and text: copies without an id go, other texts of the same id stay."""
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, one), (1, two), (2, one.upper()), (None, one), (None, "only here"), (None, "only here"), (3, two), (3, "third text"), (4, None), (5, ""), (None, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "a.text")
    left = sorted(map(str, map(tuple, nearcopies.deduplicated(docs.withColumnRenamed("a.text", "text")).collect())))
    assert left == sorted(map(str, [(1, one), (1, two), (None, "only here"), (3, "third text"), (4, None)]))
    assert nearcopies.deduplicated(docs.withColumnRenamed("a.text", "text").limit(0)).count() == 0


def test_bands_find_pairs_at_the_limit():
    rng = np.random.default_rng(1)
    found = 0
    for _ in range(1000):
        every = rng.integers(0, 1 << 63, 120, np.uint64)
        a, b = np.unique(every[:108]), np.unique(every[12:])  # 96 of 120
        assert nearcopies.similar(a, b) and not nearcopies.similar(a, b, 0.81)
        found += bool(set(nearcopies.bands(a)[:, 0].tolist()) & set(nearcopies.bands(b)[:, 0].tolist()))
    assert found >= 998


def test_tries_bring_near_copies_together(spark, monkeypatch):
    """Without any band, what the fingerprint tries join is checked and goes; a close print alone is no link."""
    monkeypatch.setattr(nearcopies, "bands", lambda found: np.zeros((0, 1 + nearcopies.ORDERS), np.int64))
    texts = [" ".join(f"g{g}w{i}" for i in range(300)) for g in range(3)]
    texts += [t + " the end" for t in texts] + [texts[0].upper(), "", None]
    prints = [simhash.fingerprint((t or "").encode(), nearcopies.SHINGLE) for t in texts]
    assert all(0 < bin(prints[g] ^ prints[g + 3]).count("1") <= simhash.BUDGET for g in range(3))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 1, 2, 7]
    assert nearcopies.deduplicated(docs, similarity=0.9999).where("doc_id < 6").count() == 6


def test_trie_buckets_against_all_pairs(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(60)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))) for p in prints[:40]]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(i, 9, p) for i, p in enumerate(signed)], "code long, n long, fp long")
    found = {r.code: r.bucket for r in nearcopies.trie_buckets(rows).collect()}
    near = [(i, j) for i in range(100) for j in range(i + 1, 100) if bin(prints[i] ^ prints[j]).count("1") <= simhash.BUDGET]
    roots = roots_of(near, 100)
    assert near and len(found) == 100
    assert all((found[i] == found[j]) == (roots[i] == roots[j]) for i in range(100) for j in range(100))


def test_every_similar_pair_of_a_bucket_is_linked(spark, monkeypatch):
    """Pairs that neither lead the one bucket of all texts nor stand next to each other in its orders."""
    monkeypatch.setattr(nearcopies, "bands", lambda found: np.array([[7, *(int(x >> np.uint64(1)) for x in found[:3])]], np.int64))
    monkeypatch.setattr(nearcopies, "trie_buckets", lambda rows: rows.limit(0).selectExpr("code", "n", "code AS bucket", "code AS order0", "code AS order1", "code AS order2"))
    rng, texts = random.Random(6), []
    for g in range(150):
        own = [f"g{g}w{i}" for i in range(60)]
        texts += [" ".join(own), " ".join(["new", *own[4:]]), " ".join([*own[:40], *(f"g{g}v{i}" for i in range(20))])]
    rng.shuffle(texts)
    assert len(slow_pairs(texts)) == 150
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id for r in nearcopies.deduplicated(docs).collect()}
    roots = roots_of(slow_pairs(texts), len(texts))
    assert left == {i for i, r in enumerate(roots) if r == i}


def test_pairs_that_are_apart_against_all_pairs(spark):
    """With buckets in one part and in several, whatever pairs may be similar are named, and none that is connected."""
    rng = random.Random(8)
    texts = []
    for g in range(25):
        base = [f"g{g}w{i}" for i in range(90 + 5 * (g % 3))]
        for i in range(8):
            texts.append(" ".join(w if rng.random() > 0.03 * i else f"e{i}" for w in base))
    sets = [nearcopies.shingles(t.encode()) for t in texts]
    shared = spark.createDataFrame([(b, i, s.size) for i, s in enumerate(sets) for b in {i % 3, 9}], "bucket long, code long, n long")
    classes = spark.createDataFrame([(i, bytearray(nearcopies.sketch(s))) for i, s in enumerate(sets)], "code long, sketch binary")
    near = [(i, j) for i in range(200) for j in range(i + 1, 200) if nearcopies.similar(sets[i], sets[j])]
    known = {i: 0 for i in range(8)}
    roots = spark.createDataFrame(list(known.items()), "node long, root long")
    for part in (1000, 30):
        found = {tuple(r) for r in nearcopies._apart(shared, classes, roots, 0.8, part).collect()}
        assert {(i, j) for i, j in near if j >= 8} <= found
        assert not any(j < 8 for _, j in found) and len(found) < 3 * len(near)
    for i, j in near[::7] + [(0, 9), (3, 199), (20, 21)]:
        only = np.setxor1d(sets[i], sets[j]).size
        differ = np.bitwise_count(np.frombuffer(nearcopies.sketch(sets[i]), np.uint8) ^ np.frombuffer(nearcopies.sketch(sets[j]), np.uint8)).sum()
        assert differ <= only
