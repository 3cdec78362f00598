"""Near-duplicate documents by SimHash fingerprints.

Fingerprints within the error budget are found by a self-join of binary tries. Two
64-bit fingerprints that differ in at most four bits agree in one of five blocks of
bits. So there are five tries, each over the fingerprints turned so that another block
comes first. A pair of nodes above that block has no error, which deals the tries out
to tasks by the block's value; below it, pairs of nodes go down together until the
errors exceed the budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import LOWER, column, raw_texts, saved, unused
from rowrelay.llm.components import components
from rowrelay.llm.trie import link

BITS = 64
SHINGLE = 4
BUDGET = 4
#: Fingerprints of one block value that one task joins; more are dealt out by pairs of parts.
PART = 1 << 18
#: Parts that each component is dealt out in when its fingerprints get their id.
PARTS = 64
_CHUNK = 1 << 16


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text: a bit is set if it is set in over half the shingles' hashes."""
    words = raw.translate(LOWER).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, hashes.size, _CHUNK):
        bits = np.unpackbits(hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > hashes.size, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row's whole text, as a signed 64-bit number.

    Null texts and those without a word have fingerprint 0.
    """
    narrow = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    schema = narrow.drop("text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x, shingle) for x in raw_texts(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return narrow.mapInArrow(run, schema)


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, bits) of budget + 1 blocks that cover all bits, from the top."""
    edges = [round(i * BITS / (budget + 1)) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def links(found: DataFrame, budget: int = BUDGET, part: int = PART) -> DataFrame:
    """(a, b): edges between different fingerprints, whose components are those of all links.

    ``found`` has unique non-null numbers in the column fp. Each task gives a spanning
    forest of the links that it finds, never all pairs of a group. A block value that
    more than ``part`` fingerprints share is cut into parts, and each pair of parts is
    a task of its own.
    """
    blocks = _blocks(budget)
    each = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", BITS - at - n).bitwiseAND((1 << n) - 1).alias("value")) for i, (at, n) in enumerate(blocks)]
    rows = found.select("fp", F.explode(F.array(*each)).alias("k")).select("fp", "k.block", "k.value")
    sizes = rows.groupBy("block", "value").count().where(F.col("count") > part)
    sizes = sizes.select("block", "value", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    rows = rows.join(sizes, ["block", "value"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    rows = rows.select("fp", "block", "value", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    rows = rows.select("fp", "block", "value", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    spread = rows.repartition("block", "value", "x", "y")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        all_rows = pd.concat(held, ignore_index=True)
        for (block, x, y), group in all_rows.groupby(["block", "x", "y"], sort=True):
            at, n = blocks[block]
            turned = group["fp"].to_numpy().view(np.uint64)
            turned = turned << np.uint64(at) | turned >> np.uint64(BITS - at) if at else turned
            order = np.argsort(turned, kind="stable")
            keys = turned[order]
            sides = group["side"].to_numpy()[order] if x != y else None
            roots = link(keys, n, budget, sides)
            moved = np.flatnonzero(roots != np.arange(roots.size))
            if moved.size:
                names = group["fp"].to_numpy()[order]
                yield pd.DataFrame({"a": names[moved], "b": names[roots[moved]]})

    return spread.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Rows are linked if their fingerprints differ in ``budget`` bits or fewer.
    component_id is the smallest id reachable from a row, itself included; null ids
    are not counted, and a component without any id has a null one. The fingerprint is
    16 lowercase hex digits. Null texts and those without words have fingerprint zero
    and are linked like any other. Repeated rows are returned as often as they occur.
    An empty table gives no rows. Other columns are not read.
    """
    rows = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    known = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(known.select("fp"), budget))
    known = saved(known.join(roots.withColumnRenamed("node", "fp"), "fp", "left"), "linked")
    # A component may hold a third of all fingerprints, so each is cut into parts.
    linked = known.where("root IS NOT NULL").withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(PARTS)).cast("int"))
    lows = linked.groupBy("root", "part").agg(F.min("low").alias("low")).groupBy("root").agg(F.min("low").alias("component_id"))
    lows = lows.select("root", "component_id", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    alone = known.where("root IS NULL").select("fp", F.col("low").alias("component_id"))
    known = saved(alone.unionByName(linked.join(lows, ["root", "part"]).select("fp", "component_id")), "classes")
    return rows.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, one of each group: the one whose id is the group's smallest.

    Of repeated rows with that id one stays. Rows without an id can't be named as
    copies of another and stay. All columns are returned.
    """
    classes = near_duplicates(docs, id_col, text_col)
    (own,) = unused(docs, "__id")
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct()
    again = classes.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(own))
    same = F.expr(f"`{id_col}` = `{own}`")
    left = docs.join(gone, same, "left_anti")
    once = left.join(again, same, "left_anti")
    many = left.join(again, same, "left_semi")
    return once.unionByName(many.dropDuplicates([id_col]))
