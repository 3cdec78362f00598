"""Benchmark passages in documents, by a prefix-filtered set join.

Every window of an item is a set of word shingles. The shingles are ordered by how
often the corpus has them, and only the rarest one of a window, its prefix under exact
containment, is joined with the documents' shingles. A join partner says where the
window would have to lie; it must lie inside the document, and the words there must be
the window's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowrelay.llm.common import column, raw_texts, saved, text_digest, unused

WINDOW = 10
SHINGLE = 5
#: Bits of the filter that picks document shingles before the join; 2**24 bits are 2 MB.
FILTER_BITS = 24
#: A-Z to a-z; other ASCII but digits and a-z to a space.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_STEP = 0x9E3779B97F4A7C15


def words_of(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of ASCII letters and digits and of all other than ASCII, lower-cased."""
    return raw.translate(_FOLD).split()


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """A 64-bit hash of each run of n words."""
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return _rolled(each, n)


def _rolled(each: np.ndarray, n: int) -> np.ndarray:
    count = max(0, each.size - n + 1)
    total = np.full(count, n, np.uint64)
    for i in range(n):
        total = total * np.uint64(_STEP) + each[i : i + count]
    return total ^ total >> np.uint64(32)


def _slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a filter of 2**bits bits."""
    mixed = hashes * np.uint64(_STEP)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64), (mixed & np.uint64((1 << bits) - 1)).astype(np.int64)


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, n, shingles): every window of every item, its words and its shingles' hashes in order."""
    narrow = items.select(column(items, id_col).cast("string").alias("item_id"), column(items, text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                words = words_of(raw)
                size, n = min(window, len(words)), min(shingle, len(words))
                if not words:
                    continue
                hashes = shingle_hashes(words, n).view(np.int64)
                for i in range(len(words) - size + 1):
                    rows.append({"item_id": item or "", "words": b" ".join(words[i : i + size]).decode(), "n": size, "shingle": n, "hashes": hashes[i : i + size - n + 1].tolist()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=made)

    made = pa.schema([("item_id", pa.string()), ("words", pa.string()), ("n", pa.int32()), ("shingle", pa.int32()), ("hashes", pa.list_(pa.int64()))])
    return narrow.mapInArrow(run, "item_id string, words string, n int, shingle int, hashes array<long>")


def _filter(tokens: DataFrame, bits: int) -> np.ndarray:
    """A bit for each place of a token; the result's size is set by ``bits`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(np.concatenate(_slots(batch.column(0).to_numpy().view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(places // 32), pa.array(1 << places % 32)], names=["cell", "bit"])

    cells = tokens.select("hash").mapInArrow(run, "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect()
    found = np.zeros(1 << bits - 5, np.uint32)
    for cell, value in cells:
        found[cell] = value
    return found


def _hits(docs: DataFrame, sizes: list[int], places: np.ndarray, bits: int, window: int) -> DataFrame:
    """(doc_id, digest, n_words, hits) of each document; hits: shingles that pass the filter, with the words around."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(places)

    def inside(hashes: np.ndarray) -> np.ndarray:
        one, two = _slots(hashes, bits)
        cells = known.value
        return (cells[one >> 5] >> (one & 31).astype(np.uint32) & cells[two >> 5] >> (two & 31).astype(np.uint32) & 1).astype(bool)

    hit = pa.struct([("pos", pa.int32()), ("hash", pa.int64()), ("first", pa.int32()), ("around", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for raw in raw_texts(batch.column(2)):
                words = words_of(raw)
                each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                own = []
                for n in sizes:
                    hashes = _rolled(each, n)
                    for i in np.flatnonzero(inside(hashes)).tolist():
                        first = max(0, i - window + n)
                        own.append({"pos": i, "hash": int(hashes[i].view(np.int64)), "first": first, "around": b" ".join(words[first : i + window]).decode()})
                counts.append(len(words))
                found.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(found, pa.list_(hit))], names=["doc_id", "digest", "n_words", "hits"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, digest long, n_words long, hits array<struct<pos:int,hash:long,first:int,around:string>>")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) of every row of docs.

    A window is ``window`` consecutive words of an item; an item of fewer words, but
    not none, is one window. n_hit counts document words inside any occurrence of a
    window, n_items the items whose windows occur, items lists their ids as sorted
    strings. Null texts have no words. Items without an id are listed as one empty id;
    items that share an id count as one. Repeated document rows each get a row, as do
    rows without an id. Empty tables give no rows, or no contamination. Other columns
    are not read.

    The corpus is read once. Only shingles that pass a filter of fixed size over the
    items' shingles leave the scan; the joins are on what is left.
    """
    return _contamination(docs, items, id_col, text_col, item_col, item_text_col, window, shingle, filter_bits).drop("digest")


def _contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE, filter_bits: int = FILTER_BITS) -> DataFrame:
    """What ``contamination`` returns, with the digest of each row's text."""
    held = saved(windows(items, item_col, item_text_col, window, shingle), "windows")
    distinct = held.groupBy("words").agg(F.first("n").alias("n"), F.first("shingle").alias("shingle"), F.first("hashes").alias("hashes"))
    tokens = distinct.select("words", "n", F.posexplode("hashes").alias("offset", "hash"))
    sizes = sorted(r[0] for r in held.select("shingle").distinct().collect())  # at most as many as words in a shingle
    text = column(docs, text_col).cast("string")
    narrow = docs.select(column(docs, id_col).alias("doc_id"), text_digest(text).alias("digest"), text.alias("text"))
    rows = saved(_hits(narrow, sizes, _filter(tokens.select("hash").distinct(), filter_bits), filter_bits, window), "hits")

    hits = rows.where(F.size("hits") > 0).select("doc_id", "digest", "n_words", F.explode("hits").alias("hit")).select("doc_id", "digest", "n_words", "hit.*")
    rarity = hits.groupBy("hash").agg(F.count("*").alias("times"))
    prefix = tokens.join(rarity, "hash").groupBy("words", "n").agg(F.min(F.struct("times", "hash", "offset")).alias("rarest"), F.count("*").alias("seen"))
    # A window with a shingle that the corpus lacks can't occur.
    whole = distinct.select("words", F.size("hashes").alias("all"))
    prefix = prefix.join(whole, "words").where("seen = all").select("words", "n", "rarest.hash", "rarest.offset")
    starts = hits.join(prefix, "hash").withColumn("start", F.col("pos") - F.col("offset"))
    starts = starts.where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
    there = F.array_join(F.slice(F.split("around", " "), F.col("start") - F.col("first") + 1, F.col("n")), " ")
    found = saved(starts.where(there == F.col("words")).select("doc_id", "digest", "start", "n", "words").distinct(), "occurrences")

    keys = ["doc_id", "digest"]
    before = Window.partitionBy(*keys).orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    ends = found.select(*keys, "start", "n").distinct().withColumn("reached", F.coalesce(F.max(F.col("start") + F.col("n")).over(before), F.lit(0)))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("n") - F.greatest("start", "reached"))
    hit = ends.groupBy(*keys).agg(F.sum(fresh).alias("n_hit"))
    named = found.select(*keys, "words").distinct().join(held.select("words", "item_id").distinct(), "words").select(*keys, "item_id").distinct()
    listed = named.groupBy(*keys).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    both = hit.join(listed, hit.doc_id.eqNullSafe(listed.doc_id) & (hit.digest == listed.digest)).select(hit.doc_id.alias("id"), hit.digest.alias("of"), "n_hit", "items")
    out = rows.drop("hits").join(both, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "digest", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_text: bool = False) -> DataFrame:
    """The documents without a window of an item, all columns kept.

    Decisions are by id, and rows without an id stay. With ``by_text`` they are by id,
    also a null one, and text, so each row is decided by its own text.
    """
    own, of = unused(docs, "__id", "__of")
    bad = _contamination(docs, items, id_col, text_col).where("contaminated").select(F.col("doc_id").alias(own), F.col("digest").alias(of))
    if not by_text:
        return docs.join(bad.select(own).distinct(), F.expr(f"`{id_col}` = `{own}`"), "left_anti")
    digest = text_digest(column(docs, text_col).cast("string"))
    return docs.join(bad.distinct(), column(docs, id_col).eqNullSafe(F.col(own)) & (digest == F.col(of)), "left_anti")
