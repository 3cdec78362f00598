"""Nearest neighbours by inner product, from one-bit codes of randomly rotated vectors.

A vector's offset from a common centre is rotated at random into a space of more
dimensions, of which each keeps one bit. Packed bits and two numbers a vector estimate
its inner product with a query and bound the error; only vectors whose upper bound
reaches the query's list so far are reranked by their exact product.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowrelay.llm.common import column, saved

#: Bits of a code for each component, and deviations of the estimate that its bound allows.
BITS, BOUND = 4, 4.0
SEED = 42
#: Vectors and queries that one task holds, and tasks at least that the vectors are dealt out to.
BLOCK, ASKED, DEALT = 1 << 17, 1 << 13, 16
#: Components of the vectors that give every query its first limit: 16,384 vectors of 64.
SAMPLE = 1 << 20
#: Vectors and queries of one step, and pairs that are reranked at once.
_ROWS, _ASKS, _PAIRS = 4096, 512, 1 << 11
#: Room for the rounding of estimates, which are single precision.
_SLACK = 1e-5


@lru_cache(4)
def rotation(size: int) -> np.ndarray:
    """A random matrix of orthonormal columns, from ``size`` components to the code's dimensions."""
    draw = np.random.default_rng(SEED).standard_normal((-(-size * BITS // 8) * 8, size))
    return np.linalg.qr(draw)[0]


def encoded(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, factor, bound) of each row of x.

    For a unit query the product with the offset is near ``factor`` times the product of
    the rotated query and the signs, and nearly always within ``bound``.
    """
    turn = rotation(x.shape[1])
    offset = x - centre
    length = np.linalg.norm(offset, axis=1)
    turned = offset @ turn.T
    size = turned.shape[1]
    along = np.abs(turned).sum(axis=1) / np.sqrt(size)  # the offset's product with its code, a unit vector
    with np.errstate(all="ignore"):
        cosine = np.where(length > 0, along / length, 1.0)
        factor = np.where(length > 0, length / cosine / np.sqrt(size), 0.0)
        bound = length * np.sqrt(np.maximum(0, 1 - cosine**2)) / cosine * BOUND / np.sqrt(max(size - 1, 1))
    bound = np.where(length > 0, bound, 0.0) + _SLACK * (length + np.linalg.norm(centre))
    return np.packbits(turned > 0, axis=1), factor, bound


def products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The inner products of rows x[i] and y[j], added from left to right in double precision."""
    out = np.empty(i.size)
    for a in range(0, i.size, _PAIRS):
        some = slice(a, a + _PAIRS)
        out[some] = np.add.accumulate(x[i[some]] * y[j[some]], axis=1)[:, -1]
    return out


def reaching(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, product) of the pairs of rows x[i] and y[j] whose product is least[i] or more.

    A product in any order of addition, which is fast, leaves out most pairs; a pair within
    its rounding of the limit is added from left to right.
    """
    room = x.shape[1] * 2 * np.finfo(float).eps
    low, high = room * np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    near = np.empty(i.size, bool)
    for a in range(0, i.size, _PAIRS):
        some = slice(a, a + _PAIRS)
        with np.errstate(all="ignore"):
            fast = np.einsum("ij,ij->i", x[i[some]], y[j[some]])
            near[some] = ~(fast + low[i[some]] * high[j[some]] < least[i[some]])
    i, j = i[near], j[near]
    score = products(x, y, i, j)
    near = ~(score < least[i])
    return i[near], j[near], score[near]


def _best(ask: np.ndarray, row: np.ndarray, score: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Which entries are among the n best of their query: by score, then by the row's first id."""
    order = np.lexsort((first[row], -score, ask))
    sorted_ = ask[order]
    begins = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    place = np.arange(order.size) - np.repeat(begins, np.diff(np.append(begins, order.size)))
    return order[place < n]


def search(
    x: np.ndarray, first: np.ndarray, codes: tuple, q: np.ndarray, centre: np.ndarray, n: int, limits: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the n nearest rows of x to each row of q, all of them if fewer.

    ``codes`` is what :func:`encoded` gives for x, ``first`` the smallest id of each row.
    Rows below a query's number in ``limits`` are left out, so there can be fewer.
    """
    bits, factor, bound = codes
    turn = rotation(x.shape[1])
    length = np.linalg.norm(q, axis=1)
    unit = q / length[:, None]
    scale = max(float(np.max(np.abs(factor), initial=0.0)), float(np.linalg.norm(centre)), np.finfo(float).tiny)
    turned, base = (unit @ turn.T).astype(np.float32), (unit @ centre / scale).astype(np.float32)
    small = (factor / scale).astype(np.float32), np.where(np.isfinite(bound), bound / scale, np.inf).astype(np.float32)
    found = []
    for a in range(0, len(q), _ASKS):
        asks = slice(a, min(a + _ASKS, len(q)))
        many = asks.stop - a
        ask, row, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        least = np.full(many, -np.inf) if limits is None else limits[asks].astype(float)
        for b in range(0, len(x), _ROWS):
            rows = slice(b, min(b + _ROWS, len(x)))
            signs = np.unpackbits(bits[rows], axis=1).astype(np.float32) * 2 - 1
            near = turned[asks] @ signs.T
            near *= small[0][rows]
            near += base[asks, None]
            if b == 0 and len(x) > n:  # the best estimates give a first limit
                top = np.argpartition(-near, n - 1, axis=1)[:, :n]
                exact = products(q[asks], x, np.repeat(np.arange(many), n), top.ravel())
                least = np.fmax(least, exact.reshape(many, n).min(axis=1))
            with np.errstate(all="ignore"):
                limit = (least / length[asks] / scale).astype(np.float32)
                near += small[1][rows]
            i, j = np.nonzero(~(near < (limit - np.abs(limit) * 1e-6)[:, None]))
            i, j, exact = reaching(q[asks], x[rows], i, j, least)
            ask, row, score = np.append(ask, i), np.append(row, j + b), np.append(score, exact)
            keep = _best(ask, row, score, first, n)
            ask, row, score = ask[keep], row[keep], score[keep]
            counts = np.bincount(ask, minlength=many)
            full = counts >= n
            least[full] = np.fmax(least[full], score[np.cumsum(counts)[full] - 1])
        found.append((ask + a, row, score))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def first_limits(some: np.ndarray, codes: tuple, q: np.ndarray, centre: np.ndarray, n: int) -> np.ndarray:
    """The n-th best product of each row of q with the rows of ``some``; no limit if they are fewer."""
    ask, _, score = search(some, np.arange(len(some)), codes, q, centre, n)
    limits = np.full(len(q), np.inf)
    np.minimum.at(limits, ask, score)
    limits[np.bincount(ask, minlength=len(q)) < n] = -np.inf
    return limits


def _codes(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bits = np.stack([np.frombuffer(b.as_py(), np.uint8) for b in rows.column("code")])
    return bits, rows.column("factor").to_numpy(), rows.column("bound").to_numpy()


def _matrix(column_: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column_.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, size)


def nearest(vectors: DataFrame, ask: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows nearest to each row for which ``ask`` holds.

    Nearness is the largest inner product; ties go to the smaller id. A row isn't its own
    neighbour; another vector of its id is, and each vector of an id has its own list. Rows whose vector is null, empty, zero or
    holds null or non-finite components, and rows without an id, take no part; repeated
    rows count once, and a shorter vector counts as filled up with zeros. Where fewer
    than k rows are left, all are returned; an empty table gives no rows.

    Equal vectors are searched as one, and of them the k + 1 smallest ids can be in a
    list, so many copies of a vector neither gather in a task nor multiply. Vectors are
    dealt out evenly in blocks of a bounded size and meet the queries in blocks, too. A
    sample of a fixed size comes to the driver first and gives each query a limit that its
    list reaches in any case; every vector is still met, and none of a list is lost by it.
    """
    spark = vectors.sparkSession
    kind = "float" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "double"
    zero = F.lit(0.0).cast(kind)
    vec = F.transform(column(vectors, vec_col).cast(f"array<{kind}>"), lambda c: c + zero)  # one kind of zero
    rows = vectors.select(column(vectors, id_col).cast("long").alias("id"), vec.alias("vec"), ask.alias("ask"))
    finite = F.forall("vec", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf")).cast(kind)))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(finite & F.exists("vec", lambda c: c != 0))
    size = rows.agg(F.max(F.size("vec"))).first()[0]
    result = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], result)
    rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(zero, F.lit(size) - F.size("vec"))))
    rows = rows.groupBy("id", "vec").agg(F.max(F.coalesce("ask", F.lit(False))).alias("ask"))
    rows = saved(rows, "vectors")

    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    some = rows.select("vec", "id").withColumn("place", place).where(F.col("place") <= k + 1)
    alike = some.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    middle = rows.select(F.posexplode("vec")).groupBy("pos").agg(F.avg(F.col("col").cast("double")).alias("mean"))
    centre = np.zeros(size)
    for pos, mean in middle.collect():  # one number a component; any centre is right, so it is rounded
        centre[pos] = round(mean, 3) if np.isfinite(mean) else 0.0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits, factor, bound = encoded(_matrix(pa.chunked_array([batch.column(1)]), size), centre)
                packed = pa.array([b.tobytes() for b in bits], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, packed, pa.array(factor), pa.array(bound)], names=["key", "vec", "ids", "code", "factor", "bound"])

    classes = alike.select(F.monotonically_increasing_id().alias("key"), "vec", "ids")
    classes = saved(classes.mapInArrow(encode, f"key long, vec array<{kind}>, ids array<long>, code binary, factor double, bound double"), "codes")
    asks = saved(rows.where("ask").join(classes.select("key", "vec"), "vec").select(F.col("id").alias("query_id"), "key"), "asks")
    wanted = classes.join(asks.select("key").distinct(), "key", "left_semi").select(F.col("key").alias("asked"), F.col("vec").alias("q"))

    many = classes.count()
    blocks = max(DEALT, -(-many // BLOCK))
    parts = max(1, -(-wanted.count() // ASKED))
    drawn = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / size / max(many, 1)))
    sample = classes.where(drawn).select("vec", "code", "factor", "bound").toArrow()

    def limited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = sample.num_rows <= k
        some, codes = (None, None) if few else (_matrix(sample.column("vec"), size), _codes(sample))
        for batch in batches:
            if batch.num_rows:
                q = _matrix(pa.chunked_array([batch.column(1)]), size)
                limits = np.full(len(q), -np.inf) if few else first_limits(some, codes, q, centre, k + 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(limits)], names=["asked", "q", "least"])

    def dealt(key: str, name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(name)

    def spread(name: str, n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    left = classes.select("*", dealt("key", "block", blocks), spread("part", parts)).groupBy("block", "part")
    wanted = wanted.mapInArrow(limited, f"asked long, q array<{kind}>, least double")
    right = wanted.select("*", dealt("asked", "of", parts), spread("at", blocks)).groupBy("at", "of")

    names = ["key", "row", "ids", "score"]
    types = pa.schema([("key", pa.int64()), ("row", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def meet(some: pa.Table, asked: pa.Table) -> pa.Table:
        if not some.num_rows or not asked.num_rows:
            return types.empty_table()
        x, q = _matrix(some.column("vec"), size), _matrix(asked.column("q"), size)
        ids = some.column("ids").combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
        ask, row, score = search(x, first, _codes(some), q, centre, k + 1, asked.column("least").to_numpy())
        return pa.Table.from_arrays([asked.column("asked").take(pa.array(ask)), some.column("key").take(pa.array(row)), some.column("ids").take(pa.array(row)), pa.array(score)], names=names)

    met = left.cogroup(right).applyInArrow(meet, "key long, row long, ids array<long>, score double")
    order = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.col("ids")[0]))
    met = met.withColumn("place", order).where(F.col("place") <= k + 1)
    each = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("id"), F.col("row")))
    lists = met.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list(each))).alias("list"))
    # The best of a class, out of which a query's own row falls.
    own = F.slice(F.filter("list", lambda s: (s["id"] != F.col("query_id")) | (s["row"] != F.col("key"))), 1, k)
    out = asks.join(lists, "key").select("query_id", F.posexplode(own).alias("pos", "s"))
    return out.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("s.id").alias("vec_id"), (-F.col("s.far")).alias("score"))
