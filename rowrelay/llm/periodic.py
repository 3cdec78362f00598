"""Runs: stretches of a text that repeat a sequence of words without a break.

Every period is tried on a grid whose step follows the period (harmonic in total): a
run covers a grid place whose word equals the one a period on, and the common
extensions from there to both sides are the run.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import column, raw_texts
from rowrelay.llm.lce import Extensions

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Words that are looked at together, and grid places of one step; a longer text is taken alone.
_WORDS, _PLACES = 1 << 18, 1 << 20

RUNS = "array<struct<start:long,length:long,period:long>>"


def _grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): for each text and period, every third multiple of the period.

    A run of four periods has equal words a period apart for three, which hold a grid place.
    """
    most = sizes // LEAST_TIMES * (sizes >= LEAST_WORDS)
    text = np.repeat(np.arange(sizes.size), most)
    period = np.arange(text.size) - np.repeat(np.cumsum(most) - most, most) + 1
    stride = (LEAST_TIMES - 1) * period
    places = -((period - sizes[text]) // stride)  # of those below size - period
    total = np.cumsum(places)
    at = 0
    while at < text.size:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PLACES)))
        n = places[at:end]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield starts[np.repeat(text[at:end], n)] + step * np.repeat(stride[at:end], n), np.repeat(period[at:end], n)
        at = end


def runs_of(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(start, end, period) of the runs in the texts of ``words``, sorted by start, then period.

    A word that occurs once must stand after each text.
    """
    right, left = Extensions(words), Extensions(words[::-1])
    last, found = words.size - 1, []
    for place, period in _grid(starts, sizes):
        same = words[place] == words[place + period]
        place, period = place[same], period[same]
        ahead = right(place, place + period)
        back = left(last - place, last - place - period)  # counts the place itself, too
        span = ahead + back - 1
        keep = (span >= (LEAST_TIMES - 1) * period) & (span + period >= LEAST_WORDS)
        start = (place - back + 1)[keep]
        found.append(np.stack([start, start + span[keep] + period[keep], period[keep]]))
    runs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort(runs[::-1])  # by start, end, period: of one stretch the smallest period counts
    runs = runs[:, order]
    first = np.ones(runs.shape[1], bool)
    first[1:] = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
    runs = runs[:, first]
    return runs[:, np.lexsort((runs[2], runs[0]))]


def _found(texts: list[list[bytes]]) -> Iterator[tuple[list[dict], bytes]]:
    """Each text's runs, and its words without those that repeat."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    words = np.zeros(int(sizes.sum()) + sizes.size, np.int64)
    for at, text in zip(starts, texts, strict=True):
        words[at : at + len(text)] = np.fromiter(map(numbers.__getitem__, text), np.int64, len(text))
    words[starts + sizes] = len(numbers) + np.arange(sizes.size)
    runs = runs_of(words, starts, sizes)
    dropped = np.zeros(words.size + 1, np.int64)
    np.add.at(dropped, runs[0] + runs[2], 1)
    np.add.at(dropped, runs[1], -1)
    kept = np.cumsum(dropped) == 0
    cuts = np.searchsorted(runs[0], np.append(starts, words.size))
    for k, (at, text) in enumerate(zip(starts, texts, strict=True)):
        own = runs[:, cuts[k] : cuts[k + 1]]
        spans = [{"start": int(s - at), "length": int(e - s), "period": int(p)} for s, e, p in own.T]
        if spans:
            text = [text[i] for i in np.flatnonzero(kept[at : at + len(text)])]
        yield spans, b" ".join(text)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def done(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        spans, kept = zip(*_found(texts), strict=True)
        sizes = pa.array([len(t) for t in texts], pa.int64())
        plain = pa.array([k.decode() for k in kept], pa.string())
        return pa.RecordBatch.from_arrays([ids, sizes, pa.array(spans, kind), plain], names=["doc_id", "n_words", "runs", "collapsed"])

    for batch in batches:
        texts, total, first = [], 0, 0
        for k, raw in enumerate(raw_texts(batch.column(1))):
            words = raw.split()
            if texts and total + len(words) > _WORDS:
                yield done(batch.column(0).slice(first, k - first), texts)
                texts, total, first = [], 0, k
            texts.append(words)
            total += len(words)
        if texts:
            yield done(batch.column(0).slice(first), texts)


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row, in one scan without a shuffle.

    ``runs`` has start and length in words and the smallest period, sorted by start, then
    period; ``collapsed`` is the text's words joined by a space, each run cut down to its
    first period. Null and empty texts have no words and no runs. Each row is taken by
    itself, so null, tied and repeated ids need nothing; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    return narrow.mapInArrow(_scan, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def strongest(found: DataFrame) -> DataFrame:
    """The rows with ``best``: the run of the greatest length by period, then of the smallest start, then period."""

    def ahead(x, y):
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        tie = (a == b) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"])))
        return (a > b) | tie

    first = F.try_element_at("runs", F.lit(1))
    return found.withColumn("best", F.aggregate("runs", first, lambda x, y: F.when(ahead(y, x), y).otherwise(x)))
