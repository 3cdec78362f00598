"""One document of each group of near copies, by SimHash tries, MinHash bands and an exact check.

Texts with the same word shingles are one class. Classes whose SimHash fingerprints are
joined by the tries of :mod:`rowrelay.llm.simhash`, op3's operator, share a bucket; beside them, as pairs
at the similarity limit differ in more bits than tries can take, so do classes whose
MinHash signatures agree in a band. In each of a few rounds a class is compared with its bucket's most
central class and with its neighbours in orders by further signature rows, unless
both are connected already; two classes are linked only if the Jaccard similarity of
their shingle sets, computed from the two texts, is high enough. These rounds connect
most near copies by pairs that grow with the classes. All other pairs of a bucket
whose classes are still apart are then compared by sketches, which only leave out
pairs that can't be similar, and the texts of the rest decide. So no two similar
classes that share a bucket stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowrelay.llm.common import LOWER, column, raw_texts, saved, text_digest, unused
from rowrelay.llm.components import components
from rowrelay.llm.simhash import BITS, BUDGET, fingerprint, links

SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS: 0.99993 at 0.8.
BANDS = 24
ROWS = 5
#: Orders of a bucket, and those of each round; each round has another leader, too.
ORDERS = 3
ROUNDS = (("order0", "order1"), ("order2",))
#: Parts that a component is dealt out in.
PARTS = 64
#: Bits of a sketch.
SKETCH = 512
#: Classes of a bucket that one task compares at once; more are dealt out by pairs of parts.
PART = 1 << 12
_BLOCK = 256
_GATHERED = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 512
_RANDOM = np.random.default_rng(42)
_FACTORS = _RANDOM.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) << np.uint64(1) | np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
#: For each band and order, the four rows after the band that order its buckets.
_NEXT = (ROWS * np.arange(1, BANDS + 1)[:, None, None] + 4 * np.arange(ORDERS)[:, None] + np.arange(4)) % (BANDS * ROWS)


def shingles(raw: bytes, n: int = SHINGLE) -> np.ndarray:
    """The set of a UTF-8 text's word shingles, as sorted 64-bit hashes; a shorter text is one shingle."""
    words = raw.translate(LOWER).split()
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(n, each.size)
    total = np.full(each.size - n + 1 if n else 0, n, np.uint64)
    for i in range(n):
        total = total * _STEP + each[i : i + total.size]
    total = (total ^ total >> np.uint64(32)) * _STEP
    return np.unique(total ^ total >> np.uint64(29))


def bands(found: np.ndarray) -> np.ndarray:
    """For each band of the set's MinHash signature its bucket and its place in each order of it; none for an empty set."""
    if not found.size:
        return np.zeros((0, 1 + ORDERS), np.int64)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, found.size, _CHUNK):
        low = np.minimum(low, (found[at : at + _CHUNK] * _FACTORS + _TERMS).min(axis=1))
    code = np.arange(1, BANDS + 1, dtype=np.uint64)
    for part in low.reshape(BANDS, ROWS).T:
        code = (code ^ code >> np.uint64(31)) * _STEP + part
    code ^= code >> np.uint64(32)
    short = ((low ^ low >> np.uint64(29)) * _STEP >> np.uint64(48))[_NEXT]
    order = short[..., 0] << np.uint64(48) | short[..., 1] << np.uint64(32) | short[..., 2] << np.uint64(16) | short[..., 3]
    return np.column_stack([code, order]).view(np.int64)


def sketch(found: np.ndarray) -> bytes:
    """For each bit whether an odd number of the set's shingles fall on it.

    A shingle that two sets share changes both sketches alike, so these differ in no more
    bits than there are shingles in only one of the sets.
    """
    at = (found >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=SKETCH) & 1 == 1).tobytes()


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the Jaccard similarity of two sets reaches the limit."""
    both = np.intersect1d(a, b, assume_unique=True).size
    return both >= similarity * (a.size + b.size - both) - 1e-9


_ORDERS = [f"order{i}" for i in range(ORDERS)]


def _scan(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, digest, code, n, fp, sketch, bands) of each row; code stands for its shingle set, fp is its fingerprint."""
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("bucket", *_ORDERS)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sizes, prints, sketches, found = [], [], [], [], []
            for raw in raw_texts(batch.column(2)):
                own = shingles(raw, shingle)
                codes.append(xxhash.xxh3_64_intdigest(own.tobytes()))
                sizes.append(own.size)
                prints.append(fingerprint(raw, shingle))
                sketches.append(sketch(own))
                found.append(bands(own))
            codes, prints = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in (codes, prints))
            every = np.concatenate([np.zeros((0, 1 + ORDERS), np.int64), *found])
            fields = pa.StructArray.from_arrays([pa.array(every[:, i]) for i in range(1 + ORDERS)], fields=list(kind.value_type))
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], codes, pa.array(sizes, pa.int64()), prints, pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(ends, fields, type=kind)], names=["doc_id", "digest", "code", "n", "fp", "sketch", "bands"])

    own = docs.schema["doc_id"].dataType.simpleString()
    each = ", ".join(f"{name}: long" for name in ("bucket", *_ORDERS))
    return docs.mapInArrow(run, f"doc_id {own}, digest long, code long, n long, fp long, sketch binary, bands array<struct<{each}>>")


def trie_buckets(rows: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(code, n, bucket, orders) of each class by its fingerprints: those that the tries join share a bucket.

    ``rows`` has code, n and fp; a class has as many rows as different fingerprints. A bucket's
    orders are those of its fingerprints, read from different bits on.
    """
    each = saved(rows.where("n > 0").select("code", "n", "fp").distinct(), "prints")
    roots = saved(components(links(each.select("fp").distinct(), budget)), "tries")
    turns = [BITS * i // ORDERS for i in range(ORDERS)]
    order = [F.shiftleft("fp", t).bitwiseOR(F.shiftrightunsigned("fp", BITS - t)) if t else F.col("fp") for t in turns]
    found = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    bucket = F.xxhash64(F.lit("trie"), F.coalesce("root", "fp")).alias("bucket")
    found = found.select("code", "n", bucket, *[o.alias(name) for o, name in zip(order, _ORDERS)])
    # A class counts once in a bucket, by its first fingerprint there.
    first = F.min(F.struct(*_ORDERS)).alias("at")
    return found.groupBy("code", "bucket").agg(F.min("n").alias("n"), first).select("code", "n", "bucket", "at.*")


def _checked(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b, same): whether the texts of each pair of classes are similar."""
    one = texts.select(F.col("code").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("code").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(raw_texts(batch.column(2)), raw_texts(batch.column(3)), strict=True)
            same = [similar(shingles(x, shingle), shingles(y, shingle), similarity) for x, y in both]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.bool_())], names=["a", "b", "same"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, same boolean")


def _neighbours(shared: DataFrame, order: str) -> DataFrame:
    """(a, b, n, m): each class of a bucket and the one before it in an order.

    The rows are dealt out by ranges, so a bucket of any size is cut among tasks; the rows
    at the cuts, two a task, are then brought together.
    """
    dealt = shared.select("bucket", F.col(order).alias("at"), "code", "n").repartitionByRange("bucket", "at", "code")
    names = ["a", "b", "n", "m", "bucket", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, at, code, n = rows = np.stack([c.to_numpy() for c in batch.columns])
            first = rows[:, 0] if first is None else first
            before = np.column_stack([rows[:, 0] if last is None else last, rows[:, :-1]])
            same = before[0] == bucket
            same[0] &= last is not None
            pairs = [code[same], before[2][same], n[same], before[3][same]]
            none = pa.nulls(int(same.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([*map(pa.array, pairs), none, none], names=names)
            last = rows[:, -1]
        if first is not None:
            ends = np.column_stack([first, last])
            none = pa.nulls(2, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ends[2]), none, pa.array(ends[3]), none, pa.array(ends[0]), pa.array(ends[1])], names=names)

    found = dealt.sortWithinPartitions("bucket", "at", "code").mapInArrow(run, "a long, b long, n long, m long, bucket long, at long")
    found = saved(found, "neighbours")
    cuts = found.where("b IS NULL").select("a", "n", "bucket", F.lag(F.struct("bucket", "a", "n")).over(Window.orderBy("bucket", "at", "a")).alias("last"))
    cuts = cuts.where("last.bucket = bucket AND last.a <> a").select("a", F.col("last.a").alias("b"), "n", F.col("last.n").alias("m"))
    return found.where("b IS NOT NULL").select("a", "b", "n", "m").unionByName(cuts)


def _links(shared: DataFrame, needed: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(node, root) of the classes that are linked, and (a, b, same) of the pairs that were compared.

    ``shared`` has bucket, code, n and the orders of the classes that share a bucket,
    ``needed`` code and rank, the smaller the more central. In each round a class is
    compared with one leader, the most central class of its bucket, and its neighbours;
    classes of a leader's component then leave its bucket's next election. Connected
    classes aren't compared again, nor are pairs that were.
    """
    near = F.least("n", "m") >= similarity * F.greatest("n", "m") - 1e-9  # else too different in size
    open_, checked, roots = shared.select("bucket", "code", "n").join(needed.select("code", "rank"), "code"), None, None
    for orders in ROUNDS:
        leaders = open_.groupBy("bucket").agg(F.min(F.struct("rank", "code", "n")).alias("lead"))
        leaders = saved(leaders.select("bucket", F.col("lead.code").alias("b"), F.col("lead.n").alias("m")), "leaders")
        led = open_.join(leaders, "bucket").select(F.col("code").alias("a"), "b", "n", "m")
        for order in orders:
            led = led.unionByName(_neighbours(shared, order))
        pairs = led.where(near & (F.col("a") != F.col("b")))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
            one = roots.select(F.col("node").alias("a"), F.col("root").alias("x"))
            two = roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
            apart = F.col("x").isNull() | F.col("y").isNull() | (F.col("x") != F.col("y"))
            pairs = pairs.join(one, "a", "left").join(two, "b", "left").where(apart).select("a", "b")
        fresh = saved(_checked(saved(pairs, "pairs"), texts, shingle, similarity), "checked")
        checked = fresh if checked is None else saved(checked.unionByName(fresh), "checked")
        roots = saved(components(checked.where("same").select("a", "b")), "roots")
        if orders != ROUNDS[-1]:
            one = roots.select(F.col("node").alias("code"), F.col("root").alias("x"))
            two = roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
            heads = leaders.join(two, "b", "left").select("bucket", F.coalesce("y", "b").alias("head"))
            open_ = open_.join(one, "code", "left").join(heads, "bucket").where(F.coalesce("x", "code") != F.col("head"))
            open_ = saved(open_.select("bucket", "code", "n", "rank"), "open")
    return roots, checked


def _possible(code: np.ndarray, n: np.ndarray, root: np.ndarray, side: np.ndarray | None, sketches: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of all pairs of classes with different roots that their sizes and sketches allow to be similar.

    With ``side`` only classes of different sides are paired.
    """
    most = (1 - similarity) / (1 + similarity)  # shingles in one set only, as a share of both sizes
    for at in range(0, code.size, _BLOCK):
        own = slice(at, at + _BLOCK)
        near = (root[own, None] != root) & (code[own, None] < code)
        if side is not None:
            near &= side[own, None] != side
        if not near.any():
            continue
        near &= np.minimum(n[own, None], n) >= similarity * np.maximum(n[own, None], n) - 1e-9
        every_i, every_j = np.nonzero(near)
        for k in range(0, every_i.size, _GATHERED):
            i, j = every_i[k : k + _GATHERED] + at, every_j[k : k + _GATHERED]
            differ = np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1, dtype=np.int64)
            keep = differ <= most * (n[i] + n[j]) + 1e-6
            yield i[keep], j[keep]


def _apart(shared: DataFrame, classes: DataFrame, roots: DataFrame, similarity: float, part: int = PART) -> DataFrame:
    """(a, b): all pairs of classes that share a bucket, aren't connected and may be similar.

    ``shared`` has bucket, code and n, ``classes`` code and sketch. A bucket of more than
    ``part`` classes is cut into parts, and each pair of parts is a group of its own, so a task
    holds two parts at most. The work in a bucket grows with its pairs; a pair costs a
    look at two roots, and two sketches if these differ and the sizes allow a link.
    """
    rooted = shared.select("bucket", "code", "n").join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    open_ = rooted.groupBy("bucket").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rows = rooted.join(open_.select("bucket", F.ceil(F.col("size") / part).cast("int").alias("parts")), "bucket")
    rows = saved(rows.join(classes.select("code", "sketch"), "code"), "apart")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    x, y, side = F.least("own", "other"), F.greatest("own", "other"), (F.col("own") > F.col("other")).cast("int")
    rows = rows.select("bucket", x.cast("long").alias("x"), y.cast("long").alias("y"), side.cast("long").alias("side"), "root", "code", "n", "sketch")

    def pairs(numbers: np.ndarray, sketches: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.r_[True, (numbers[:3, 1:] != numbers[:3, :-1]).any(axis=0)])
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), numbers.shape[1]], strict=True):
            _, (x, *_), (y, *_), side, root, code, n = numbers[:, lo:hi]
            for i, j in _possible(code, n, root, side if x != y else None, sketches[lo:hi], similarity):
                if i.size:
                    yield pa.RecordBatch.from_arrays([pa.array(code[i]), pa.array(code[j])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, sketches = np.zeros((7, 0), np.int64), np.zeros((0, SKETCH // 64), np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = np.hstack([numbers, np.stack([c.to_numpy() for c in batch.columns[:7]])])
            sketches = np.vstack([sketches, np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint64).reshape(-1, SKETCH // 64)])
            ends = np.flatnonzero((numbers[:3, 1:] != numbers[:3, :-1]).any(axis=0)) + 1
            if ends.size:  # the last group may go on
                yield from pairs(numbers[:, : ends[-1]], sketches[: ends[-1]])
                numbers, sketches = numbers[:, ends[-1] :], sketches[ends[-1] :]
        if numbers.size:
            yield from pairs(numbers, sketches)

    dealt = rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "root")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _completed(shared: DataFrame, classes: DataFrame, texts: DataFrame, roots: DataFrame, checked: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(node, root) when all similar classes that share a bucket are linked, from those that ``_links`` has found."""
    pairs = _apart(shared, classes, roots, similarity).join(checked, ["a", "b"], "left_anti")
    fresh = saved(_checked(saved(pairs, "pairs"), texts, shingle, similarity), "checked").where("same")
    if fresh.isEmpty():
        return roots
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return saved(components(stars.unionByName(fresh.select("a", "b"))), "roots")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, digest, kept_id, kept_digest) of every row: the row that stays for it.

    Rows are told apart by their id, also a null one, and their text's digest. The row
    that stays is the one of the smallest id in its group, null ids last. Texts without
    words are copies of each other.
    """
    text = column(docs, text_col).cast("string")
    narrow = docs.select(column(docs, id_col).alias("doc_id"), text_digest(text).alias("digest"), text.alias("text"))
    rows = saved(_scan(narrow, shingle), "signatures")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("digest").alias("of"))
    classes = saved(rows.groupBy("code").agg(F.min(key).alias("key"), F.min("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "classes")
    each = saved(trie_buckets(rows), "buckets").unionByName(classes.select("code", "n", F.inline("bands")))
    many = each.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = saved(each.join(many, "bucket"), "shared")
    # A class that meets the most others is central: in a group of variants, the text they come from.
    needed = shared.groupBy("code").agg(F.sum("size").alias("met")).join(classes.select("code", "key"), "code")
    needed = saved(needed.select("code", "key", F.struct(-F.col("met"), F.col("key")).alias("rank")), "needed")
    own = needed.select("code", F.col("key.id").alias("__id"), F.col("key.of").alias("__of"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__of"))
    texts = saved(narrow.join(own, same).groupBy("code").agg(F.first("text").alias("text")), "texts")
    roots, checked = _links(shared, needed, texts, shingle, similarity)
    roots = _completed(shared, classes, texts, roots, checked, shingle, similarity)

    known = classes.select("code", "key").join(roots.withColumnRenamed("node", "code"), "code", "left")
    known = saved(known, "linked")
    # A component may hold a third of all classes, so each is cut into parts.
    linked = known.where("root IS NOT NULL").withColumn("part", F.pmod(F.xxhash64("code"), F.lit(PARTS)).cast("int"))
    lows = linked.groupBy("root", "part").agg(F.min("key").alias("key")).groupBy("root").agg(F.min("key").alias("kept"))
    lows = lows.select("root", "kept", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    alone = known.where("root IS NULL").select("code", F.col("key").alias("kept"))
    known = saved(alone.unionByName(linked.join(lows, ["root", "part"]).select("code", "kept")), "kept")
    return rows.join(known, "code").select("doc_id", "digest", F.col("kept.id").alias("kept_id"), F.col("kept.of").alias("kept_digest"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, one of each group of near copies; all columns are returned.

    Each document that goes is tied to one that stays by a chain of texts whose shingle
    sets have at least the similarity. Two similar texts may both stay only if no trie joins
    their fingerprints and they share no band. Rows
    with the same id, also a null one, and different texts are different documents; of
    repeated rows one stays.
    """
    own, of = unused(docs, "__id", "__of")
    found = saved(representatives(docs, id_col, text_col, shingle, similarity), "representatives")
    stays = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    names = [F.col("doc_id").alias(own), F.col("digest").alias(of)]
    gone = found.where(~stays).select(*names).distinct()
    again = found.where(stays).groupBy("doc_id", "digest").count().where("count > 1").select(*names)
    digest = text_digest(column(docs, text_col).cast("string"))
    same = column(docs, id_col).eqNullSafe(F.col(own)) & (digest == F.col(of))
    left = docs.join(gone, same, "left_anti")
    same = column(left, id_col).eqNullSafe(F.col(own)) & (text_digest(column(left, text_col).cast("string")) == F.col(of))
    once = left.join(again, same, "left_anti")
    many = left.join(again, same, "left_semi")
    return once.unionByName(many.dropDuplicates([id_col, text_col]))
