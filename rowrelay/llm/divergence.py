"""How far the sources of a language diverge in their terms, audited pair by pair.

Term shares are whole numbers (parts of a thousand million, smoothed), so all sums are
exact. Pair sums follow Gustavson: the index is term-major, and each source's row
scatters its terms' postings into a dense accumulator over the language's sources. Only
corrections against the shares of absent terms are scattered; the rest, which every
pair has, is computed from each source's histogram of counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowrelay.llm.common import column, raw_texts, saved

#: A kept term is in so many documents of its language.
LEAST_DOCS = 10
#: Shares are parts of this; this many occurrences are added to each term.
PARTS, ADDED = 1_000_000_000, 2
#: Terms of a source that the report lists.
TOP = 10
#: For UTF-8 bytes: letters, A-Z folded, and all of other scripts stay; the rest divides.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Entries that a task holds before it hands them on: counted terms, and cells of accumulators.
_HELD, _CELLS = 1 << 18, 1 << 22
#: Postings that are scattered at once, and parts that a language's pairs are dealt out in.
_SCATTER, _DEAL = 1 << 18, 16


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's documents, added up as far as memory allows."""
    times: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def held() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in times.items():
            some = docs[lang, source]
            terms = pa.array([t.decode() for t in own], pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array([source] * len(own), pa.string()), terms, pa.array(own.values(), pa.int64()), pa.array([some[t] for t in own], pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )

    size = 0
    for batch in batches:
        for raw, lang, source in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            found = Counter(raw.translate(_LETTERS).split())
            own = times.setdefault((lang, source), Counter())
            size -= len(own)
            own.update(found)
            size += len(own)
            docs.setdefault((lang, source), Counter()).update(dict.fromkeys(found, 1))
            if size > _HELD:
                yield from held()
                times, docs, size = {}, {}, 0
    yield from held()


def share(n: Column, total: Column, kept: Column) -> Column:
    """A term's part of PARTS, exact at any size: 1 + floor(PARTS * (n + ADDED) / (total + ADDED * kept))."""
    top = F.lit(PARTS).cast("decimal(10,0)") * (n + ADDED).cast("decimal(19,0)")
    return 1 + F.call_function("div", top, (total + ADDED * kept).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); shares are at most PARTS + 1, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _scatter(acc: dict, lang: str, index: tuple[np.ndarray, ...], ends: np.ndarray) -> None:
    """Add a batch of index rows of one language to the sources' accumulators.

    ``index`` has the postings of one term after the other: source number, share, and the
    share of a term that the source doesn't have. Pairs are held at the smaller number.
    """
    who, p, p0 = index
    begins = np.append(0, ends[:-1])
    size = np.diff(np.append(0, ends))
    term = np.repeat(np.arange(ends.size), size)
    order = np.argsort(who, kind="stable")
    cuts = np.flatnonzero(np.append(True, who[order][1:] != who[order][:-1]))
    width = int(who.max()) + 1
    for a, b in zip(cuts, np.append(cuts[1:], order.size), strict=True):
        row = order[a:b]  # the postings of one source: its row's terms
        g = int(who[row[0]])
        old = acc.get((lang, g))
        if old is None or old.size < width:
            new = np.zeros(width, np.int64)
            if old is not None:
                new[: old.size] = old
            acc[lang, g] = old = new
        n = size[term[row]]
        total = np.cumsum(n)
        at = 0
        while at < row.size:
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _SCATTER)))
            some, many = row[at:end], n[at:end]
            peer = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begins[term[some]], many)
            own = np.repeat(some, many)
            later = who[peer] > g
            peer, own = peer[later], own[later]
            x, x0, y, y0 = p[own], p0[own], p[peer], p0[peer]
            value = _gaps(x, y) - _gaps(x, y0) - _gaps(x0, y) + _gaps(x0, y0)
            np.add.at(old, who[peer], value)
            at = end


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value): the corrections of a task's terms, a pair of sources once for each time memory was full."""
    acc: dict[tuple[str, int], np.ndarray] = {}

    def held() -> Iterator[pa.RecordBatch]:
        for (lang, g), own in acc.items():
            peers = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * peers.size, pa.string()), pa.array(np.full(peers.size, g), pa.int64()), pa.array(peers, pa.int64()), pa.array(own[peers])], names=["lang", "a", "b", "value"]
            )

    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            rows = batch.column(1).filter(pc.equal(langs.indices, k))
            flat = rows.flatten()
            ends = np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            _scatter(acc, lang, tuple(flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)), ends)
        if sum(own.size for own in acc.values()) > _CELLS:
            yield from held()
            acc = {}
    yield from held()


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of each pair, and the terms that set a source apart.

    Part ``pair`` has every other source of the language with the sum over all kept terms;
    part ``term`` has the TOP terms that are more frequent in the source than in its
    language. Null texts, languages and sources are empty ones; a source without kept terms
    has all shares of an absent term, and a language without them only zeros. Rows that
    repeat count each time. Ids and other columns are not read.

    Counts are added up by language, source and term before a term's postings meet, so a
    frequent term sends one posting a source, and a hot source is dealt out by its terms.
    """
    plain = [F.coalesce(column(docs, c).cast("string"), F.lit("")) for c in (text_col, lang_col, source_col)]
    narrow = docs.select(plain[0].alias("text"), plain[1].alias("lang"), plain[2].alias("source"))
    counts = narrow.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    index = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"), F.collect_list(F.struct("source", "n")).alias("postings"))
    index = saved(index.where(F.col("docs") >= LEAST_DOCS).drop("docs"), "terms")
    flat = index.select("lang", "term", "all", F.inline("postings"))

    kept = index.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = narrow.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    absent = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))).otherwise(1)
    sources = saved(sources.withColumn("who", number.cast("long")).withColumn("p0", absent.cast("long")), "sources")

    own = share(F.col("n"), F.col("total"), F.col("kept"))
    common = share(F.col("all"), F.col("lang_total"), F.col("kept"))
    shares = flat.join(sources, ["lang", "source"]).select("lang", "source", "term", "who", "n", own.alias("p"), "p0", common.alias("q"))
    shares = saved(shares, "shares")

    rows = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("who", "p", "p0")).alias("postings")).select("lang", "postings")
    met = rows.mapInArrow(_partial_sums, "lang string, a long, b long, value long")

    # What a source's terms add against a peer that has none of them: a sum over the source's different counts.
    levels = shares.groupBy("lang", "who", "p").agg(F.count("*").alias("times"))
    levels = levels.groupBy("lang", "who").agg(F.collect_list(F.struct("p", "times")).alias("levels"))
    each = saved(sources.join(levels, ["lang", "who"], "left"), "levels")
    # A language may hold most sources, so its pairs are dealt out by the first one; the narrow side is copied.
    part = F.pmod("who", F.lit(_DEAL)).alias("part")
    one = each.select("lang", part, F.col("who").alias("a"), F.col("source").alias("source_a"), F.col("p0").alias("p0_a"), "levels", "kept")
    two = sources.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_DEAL - 1).cast("long"))).alias("part"), F.col("who").alias("b"), F.col("source").alias("source_b"), F.col("p0").alias("p0_b"))
    base = gap(F.col("p0_a"), F.col("p0_b"))
    against = F.aggregate("levels", F.lit(0).cast("long"), lambda s, x: s + x["times"] * (gap(x["p"], F.col("p0_b")) - base))
    both = one.join(two, ["lang", "part"]).where("a <> b")
    ahead = F.col("a") < F.col("b")
    least = F.coalesce(against, F.lit(0)) + F.when(ahead, F.col("kept") * base).otherwise(0)
    names = F.when(ahead, F.struct("source_a", "source_b")).alias("names")
    least = both.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), least.alias("value"), names)
    pairs = least.unionByName(met, allowMissingColumns=True).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.max("names").alias("names"))
    pairs = pairs.select("lang", "value", "names.*")
    both = F.inline(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    pairs = pairs.select("lang", "value", both)
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(first).alias("rank"))

    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= TOP)
    return pairs.unionByName(terms)
