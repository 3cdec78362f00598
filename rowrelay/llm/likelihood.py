"""Quality rules by a hashed n-gram likelihood ratio.

Words and word pairs are hashed to buckets. Two multinomials over the buckets, of the
trusted documents and of the whole corpus, give each n-gram a log ratio; a document's
score is the sum over its n-grams by their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import column, raw_texts

BUCKETS = 1 << 18
#: N-grams of the corpus's own mix that are added to each bucket, so that a rare one says little.
SMOOTHING = 100
#: N-grams of ratio one that are added to each text, so that a few of them decide nothing.
PRIOR = 20
#: Least score that is kept, a natural log; chosen on held-out labels.
LEAST = -0.08
#: N-grams counted at once.
_AT_ONCE = 1 << 20
_SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_SYMBOLS = tuple(bytes([c]) for c in b"#*$%&|<>")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_REPEAT = 5


def word_hashes(raw: bytes) -> np.ndarray:
    words = raw.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams(words: np.ndarray, buckets: int) -> np.ndarray:
    """The buckets of a text's words and word pairs."""
    pairs = words[:-1] * _STEP + words[1:]
    both = np.concatenate([words, pairs]) * _STEP
    return (both >> np.uint64(40)).astype(np.int64) % buckets


def repeated_words(words: np.ndarray) -> int:
    """Words inside windows of five words that occur twice or more in the text."""
    n = words.size - _REPEAT + 1
    if n < 2:
        return 0
    code = np.zeros(n, np.uint64)
    for i in range(_REPEAT):
        code = code * _STEP + words[i : i + n]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(words.size + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + _REPEAT, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier one."""
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, corpus, trusted): n-gram counts of all documents and of the trusted ones.

    ``docs`` has the columns text and trusted. A task sends one row a bucket at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, size = np.zeros((2, buckets), np.int64), ([], []), 0

        def count() -> None:
            for row, found in zip(counts, waiting, strict=True):
                if found:
                    row += np.bincount(np.concatenate(found), minlength=buckets)
                    found.clear()

        for batch in batches:
            for raw, trusted in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found = grams(word_hashes(raw), buckets)
                for kind in waiting[: 1 + trusted]:
                    kind.append(found)
                size += found.size
                if size >= _AT_ONCE:
                    count()
                    size = 0
        count()
        some = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])], names=["bucket", "corpus", "trusted"])

    each = docs.select("text", "trusted").mapInArrow(run, "bucket long, corpus long, trusted long")
    return each.groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted"))


def ratios(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray | None:
    """Each bucket's log ratio; None without trusted n-grams. At most ``buckets`` rows come to the driver.

    Smoothing adds ``smoothing`` n-grams to each bucket, trusted by the corpus's own
    share, so a bucket's ratio is drawn to zero by how little it was seen. The buckets that
    a finer hash splits off are rare ones: verdicts hardly move with their number.
    """
    corpus, trusted = np.zeros(buckets), np.zeros(buckets)
    found = counts.toArrow()
    at = found["bucket"].to_numpy()
    corpus[at], trusted[at] = found["corpus"].to_numpy(), found["trusted"].to_numpy()
    if not trusted.any():
        return None
    share = trusted.sum() / corpus.sum()
    return np.log((trusted + smoothing * share) / (corpus + smoothing)) - np.log(share)


def judged(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, smoothing: float = SMOOTHING, prior: float = PRIOR, least: float = LEAST) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept) of every row.

    ``trusted_ids`` has one column, the ids of the trusted target documents; nulls and
    repeats in it change nothing. The two multinomials count every n-gram of every
    document. score is the sum of log ratios over a document's n-grams, divided by
    their number plus ``prior`` and rounded to six digits; a text without words has
    none. A document is kept if it doesn't fail the
    base rules and its score is at least ``least``. Without any trusted n-gram there
    is no ratio: scores are null and the base rules decide alone. Null texts have no
    words. Repeated rows each count and get a row; an empty table gives none. Other
    columns are not read.
    """
    text = column(docs, text_col).cast("string")
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("__id")).distinct().withColumn("trusted", F.lit(True))
    narrow = docs.select(column(docs, id_col).alias("doc_id"), text.alias("text"))
    # The ids grow with the corpus, so they are never broadcast: one plan for every size.
    marked = narrow.join(ids.hint("merge"), F.col("doc_id") == F.col("__id"), "left").select("text", F.col("trusted").isNotNull().alias("trusted"))
    table = ratios(bucket_counts(marked, buckets), buckets, smoothing)
    known = docs.sparkSession.sparkContext.broadcast(table)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = pc.utf8_length(batch.column(1)).to_pylist()
            rows, scores = [], []
            for raw, n_points in zip(raw_texts(batch.column(1)), points, strict=True):
                words = word_hashes(raw)
                blank = sum(map(raw.count, _SPACES))
                rows.append((words.size, (n_points or 0) - blank, sum(map(raw.count, _SYMBOLS)), repeated_lines(raw), repeated_words(words)))
                found = grams(words, buckets)
                scores.append(None if known.value is None or not words.size else round(float(known.value[found].sum()) / (found.size + prior), 6))
            columns = np.array(rows, np.int64).reshape(-1, len(names)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns), pa.array(scores, pa.float64())], names=["doc_id", *names, "score"])

    out = narrow.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names) + ", score double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score").isNull() | (F.col("score") >= least)))
