"""A quality classifier by co-training two views of a document.

One view is the text's content, as hashed byte trigrams. The other is what is known
about the page: language, source, size and layout. Each view has a classifier of its
own. In each round the documents without a label that one view is sure about become
training rows of the other view. In the end both views' scores are calibrated on
labelled rows held out from training, combined, and given to every document.

The fits are Newton steps over all training rows: each task adds up what its rows give to
a step's slope and bend, and the driver gets the sums alone, whose size is that of a view.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import column, raw_texts, saved, text_digest, unused
from rowrelay.llm.mixture import running

#: Features of the content view; a trigram's share is stored in one byte.
BUCKETS = 512
ROUNDS = 2
#: A view is sure of a label at this probability.
SURE = 0.95
#: A document is kept from this probability of good quality.
LEAST = 0.35
#: Rows that one task adds up, about; each task sends one set of sums.
TASK_ROWS = 1 << 15
#: So many tasks send their sums straight to the driver.
FEW = 4
#: Numbers of a sum that are added up and sent as one.
_PIECE = 1 << 12
_CHUNK = 2048
_META = 32
_SIZES = 11
_LANGS = 8


def content(raw: bytes) -> np.ndarray:
    """Square roots of the shares of a text's byte trigrams, hashed, each as one byte."""
    data = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if data.size < 3:
        return np.zeros(BUCKETS, np.uint8)
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761)
    counts = np.bincount(code >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return np.minimum(255, np.sqrt(counts / code.size) * 510).astype(np.uint8)


def metadata(raw: bytes, points: int, lang: str | None, source: str | None) -> np.ndarray:
    """Language, source, size and layout of a page, each scaled to about 0 to 1."""
    found = np.zeros(_META, np.float32)
    words, rows = raw.split(), [x for x in raw.split(b"\n") if x]
    spaces = sum(map(raw.count, (b" ", b"\n", b"\t")))
    lines, size = raw.count(b"\n") + 1, max(1, points)
    marks = sum(map(raw.count, (b".", b",", b";", b"?", b"!", b":")))
    symbols = sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    digits = sum(raw.count(b"%d" % d) for d in range(10))
    repeats = 1 - len(set(rows)) / max(1, len(rows)), 1 - len(set(words)) / max(1, len(words)), 1 - len(set(zip(words, words[1:]))) / max(1, len(words) - 1)
    found[:_SIZES] = (*repeats, np.log1p(points) / 12, np.log1p(lines) / 8, np.log1p(size / lines) / 10, spaces / size * 4, marks / size * 10, min(1.0, symbols / size * 10), min(1.0, digits / size * 10), (size - spaces) / (spaces + 1) / 20)
    found[_SIZES + xxhash.xxh3_64_intdigest((lang or "").encode()) % _LANGS] = 1
    found[_SIZES + _LANGS + xxhash.xxh3_64_intdigest((source or "").encode(), 1) % (_META - _SIZES - _LANGS)] = 1
    return found


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, content, meta): both views of each row as bytes, from columns doc_id, digest, text, lang, source."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = pc.utf8_length(batch.column(2)).to_pylist()
            langs, sources = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            one, two = [], []
            for raw, n, lang, source in zip(raw_texts(batch.column(2)), points, langs, sources, strict=True):
                one.append(content(raw).tobytes())
                two.append(metadata(raw, n or 0, lang, source).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(one, pa.binary()), pa.array(two, pa.binary())], names=["doc_id", "digest", "content", "meta"])

    return docs.select("doc_id", "digest", "text", "lang", "source").mapInArrow(run, f"doc_id {kind}, digest long, content binary, meta binary")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _matrix(blobs: list[bytes], kind: str) -> np.ndarray:
    flat = np.frombuffer(b"".join(blobs), kind)
    return flat.reshape(len(blobs), -1).astype(np.float64) if blobs else np.zeros((0, 1))


#: What a fit asks for (a function of rows and labels that gives sums) and is sent (these over all rows); it returns its result.
Asking = Generator[Callable[[np.ndarray, np.ndarray], np.ndarray], np.ndarray]


def _moments(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(labels), (labels == 1).sum()], rows.sum(axis=0), (rows * rows).sum(axis=0)])


def _spread(found: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Rows, rows of label 1, means and standard deviations from :func:`_moments`."""
    n, ones, (total, squares) = found[0], found[1], found[2:].reshape(2, -1)
    return n, ones, total / n, np.sqrt(np.maximum(0, squares / n - (total / n) ** 2))


def _newton(rows: np.ndarray, labels: np.ndarray, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, share: float) -> np.ndarray:
    """The slope of the logistic loss, and the upper half of its bend."""
    x = np.hstack([(rows - mean) / scale, np.ones((len(rows), 1))])
    p, importance = sigmoid(x @ weights), np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    slope = x.T @ (importance * (p - labels))
    x *= np.sqrt(importance * p * (1 - p) + 1e-9)[:, None]
    return np.concatenate([slope, (x.T @ x)[np.triu_indices(len(weights))]])


def _platt(scores: np.ndarray, labels: np.ndarray, middle: float, wide: float, goals: tuple[float, float], w: np.ndarray) -> np.ndarray:
    """Loss, slope and bend of Platt's scaling at w."""
    x, goal = np.stack([(scores[:, 0] - middle) / wide, np.ones(len(scores))], axis=1), np.where(labels == 1, goals[1], goals[0])
    z = x @ w
    p = sigmoid(z)
    return np.concatenate([[np.logaddexp(0, z).sum() - goal @ z], x.T @ (p - goal), ((x.T * (p * (1 - p))) @ x).ravel()])


def _error(scores: np.ndarray, labels: np.ndarray, curve: tuple[float, float], most: float) -> np.ndarray:
    logits = np.clip(curve[0] * scores[:, 0] + curve[1], -most, most)
    return np.array([np.abs(sigmoid(logits) - labels).sum()])


def _together(fits: list[Asking], sums: Callable[[dict], dict]) -> list:
    """What several fits return; ``sums`` answers the open questions of all of them in one pass over the rows."""
    found, asks = [None] * len(fits), {i: next(fit) for i, fit in enumerate(fits)}
    while asks:
        answers, asks = sums(asks), {}
        for i, answer in answers.items():
            try:
                asks[i] = fits[i].send(answer)
            except StopIteration as end:
                found[i] = end.value
    return found


@dataclass
class Logistic:
    """Regularised logistic regression, by Newton steps, classes weighted alike."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def asking(cls, penalty: float = 1.0, steps: int = 12) -> Asking:
        n, ones, mean, scale = _spread((yield _moments))
        scale, share = scale + 1e-6, np.clip(ones / n, 1e-6, 1 - 1e-6)
        weights, fine = np.zeros(mean.size + 1), np.full(mean.size + 1, penalty)
        fine[-1] = 1e-6
        half = np.triu_indices(weights.size)
        for _ in range(steps):
            found = yield partial(_newton, mean=mean, scale=scale, weights=weights, share=share)
            slope, bend = found[: weights.size] + fine * weights, np.zeros((weights.size, weights.size))
            bend[half] = found[weights.size :]
            bend = bend + np.triu(bend, 1).T + np.diag(fine)
            move = np.linalg.solve(bend, slope)
            weights = weights - move
            if np.abs(move).max() < 1e-6:
                break
        return cls(mean, scale, weights)

    @classmethod
    def fit(cls, rows: np.ndarray, labels: np.ndarray, penalty: float = 1.0, steps: int = 12) -> Logistic:
        return _together([cls.asking(penalty, steps)], lambda asks: {i: ask(rows, labels) for i, ask in asks.items()})[0]

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]


def _calibrating() -> Asking:
    n, n1, middle, wide = _spread((yield _moments))
    middle, wide, goals = float(middle[0]), float(wide[0]) + 1e-9, (1 / (n - n1 + 2), (n1 + 1) / (n1 + 2))

    def at(w: np.ndarray) -> Callable:
        return partial(_platt, middle=middle, wide=wide, goals=goals, w=w)

    def loss(found: np.ndarray, w: np.ndarray) -> float:
        return found[0] + 0.05 * w @ w

    w = np.zeros(2)
    here = yield at(w)
    for _ in range(50):
        move = np.linalg.solve(here[3:].reshape(2, 2) + 0.1 * np.eye(2), here[1:3] + 0.1 * w)
        there = yield at(w - move)
        while loss(there, w - move) > loss(here, w) * (1 + 1e-12) and np.abs(move).max() > 1e-9:
            move = move / 2
            there = yield at(w - move)
        w, here = w - move, there
        if np.abs(move).max() < 1e-9:
            break
    slope = float(w[0] / wide)
    return slope, float(w[1] - slope * middle)


def calibrated(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn a view's scores into log odds, by Platt's smoothed targets."""
    return _together([_calibrating()], lambda asks: {i: ask(scores[:, None], labels) for i, ask in asks.items()})[0]


@dataclass
class Model:
    """Both views' classifiers, and how their scores are calibrated and weighted."""

    content: Logistic
    meta: Logistic
    curves: tuple[tuple[float, float], tuple[float, float]] = ((1.0, 0.0), (1.0, 0.0))
    #: The largest log odds, by the number of held-out rows.
    most: float = 7.0
    shares: tuple[float, float] = (0.5, 0.5)

    def logits(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of either view."""
        (a, b), (c, d) = self.curves
        found = a * self.content.logit(content) + b, c * self.meta.logit(meta) + d
        return np.clip(found[0], -self.most, self.most), np.clip(found[1], -self.most, self.most)

    def score(self, content: np.ndarray, meta: np.ndarray) -> np.ndarray:
        one, two = self.logits(content, meta)
        return sigmoid(self.shares[0] * one + self.shares[1] * two)


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, digest, p_content, p_meta, score) of staged rows, six digits each."""
    known = rows.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = _matrix(batch.column(2).to_pylist(), "u1"), _matrix(batch.column(3).to_pylist(), "<f4")
            views = known.value.logits(one, two)
            found = [sigmoid(views[0]), sigmoid(views[1]), known.value.score(one, two)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(x.round(6)) for x in found)], names=["doc_id", "digest", "p_content", "p_meta", "score"])

    return rows.select("doc_id", "digest", "content", "meta").mapInArrow(run, f"doc_id {kind}, digest long, p_content double, p_meta double, score double")


def _summed(rows: DataFrame, asks: dict[int, Callable], given: Callable[[pa.RecordBatch], list], tasks: int) -> dict[int, np.ndarray]:
    """The sums over all rows of what each of ``asks`` makes of the rows and labels that ``given`` finds in a batch for it.

    Each of so many tasks sends one set of sums, cut into pieces; those of more than ``FEW``
    tasks are added up by piece before the driver gets them.
    """
    kind = "fit int, at int, task int, sums binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for k in range(0, batch.num_rows, _CHUNK):
                every = given(batch.slice(k, _CHUNK))
                for i, ask in asks.items():
                    own = ask(*every[i])
                    sums[i] = sums[i] + own if i in sums else own
        task = TaskContext.get().partitionId()
        cut = [(i, at, task, own[at : at + _PIECE].astype("<f8").tobytes()) for i, own in sums.items() for at in range(0, own.size, _PIECE)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*cut, strict=True), kinds, strict=True)], names=names) if cut else none

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for i, at, _, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[i, at] = sums.get((i, at), 0) + np.frombuffer(blob, "<f8")
        cut = [(i, at, 0, own.tobytes()) for (i, at), own in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*cut, strict=True), kinds, strict=True)], names=names) if cut else none

    names, kinds = ["fit", "at", "task", "sums"], [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    none = pa.RecordBatch.from_arrays([pa.array([], t) for t in kinds], names=names)
    found = rows.coalesce(tasks).mapInArrow(run, kind)
    if tasks > FEW:  # in the order of the tasks, so that reruns agree
        found = found.repartition("fit", "at").sortWithinPartitions("fit", "at", "task").mapInArrow(add, kind)
    sums: dict[int, dict[int, np.ndarray]] = {i: {} for i in asks}
    for r in sorted(found.collect(), key=lambda r: (r.fit, r.at, r.task)):
        sums[r.fit][r.at] = sums[r.fit].get(r.at, 0) + np.frombuffer(r.sums, "<f8")
    return {i: np.concatenate(list(own.values())) for i, own in sums.items()}


def _given(batch: pa.RecordBatch, model: Model | None, sure: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For either view the training rows among those of a batch, and their labels: known ones, and those that the other view is sure of."""
    views = _matrix(batch.column(0).to_pylist(), "u1"), _matrix(batch.column(1).to_pylist(), "<f4")
    label, held = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
    goals = [np.where(held, -1, label) for _ in views]
    blank = label < 0
    if model is not None and blank.any():
        for taker, logits in zip((1, 0), model.logits(*views), strict=True):
            p = sigmoid(logits).round(6)
            goals[taker][blank & (p >= sure)] = 1
            goals[taker][blank & (p <= 1 - sure)] = 0
    return [(view[goal >= 0], goal[goal >= 0]) for view, goal in zip(views, goals, strict=True)]


def _held_scores(rows: DataFrame, fits: list[Logistic]) -> DataFrame:
    """(label, content, meta): either view's scores of the rows to calibrate on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                views = _matrix(batch.column(0).to_pylist(), "u1"), _matrix(batch.column(1).to_pylist(), "<f4")
                yield pa.RecordBatch.from_arrays([batch.column(2), *(pa.array(fit.logit(x)) for fit, x in zip(fits, views, strict=True))], names=["label", "content", "meta"])

    return saved(rows.select("content", "meta", "label").mapInArrow(run, "label int, content double, meta double"), "held")


def train(rows: DataFrame, labelled: int | None = None, rounds: int = ROUNDS, sure: float = SURE) -> Model | None:
    """Co-train both views on staged features with a label or null; None unless both labels occur.

    All labelled rows are fitted on, but for every fourth by hash, which calibrates; of
    ``labelled``, if given, only so many, the first by hash. In each round every row without a label that one view is sure of
    becomes a training row of the other view, repeated rows once.
    """
    known = rows.where("label IS NOT NULL").withColumn("draw", F.xxhash64("doc_id", "digest")).withColumns({"all": F.lit(0), "one": F.lit(1)})
    known = running(known, ["all"], ["draw", "doc_id", "digest"], {"place": "one"})
    if labelled is not None:
        known = known.where(F.col("place") < labelled)
    known = saved(known.select("content", "meta", "label", (F.col("place") % 4 == 3).alias("held")), "labelled")  # held: for calibration
    sizes = {(r.label, r.held): r["count"] for r in known.groupBy("label", "held").count().collect()}
    if len({label for label, _ in sizes}) < 2:
        return None
    if len(sizes) < 4:
        known, use = known.withColumn("held", F.lit(False)), known
    else:
        use = known.where("held")
    n_use = sum(n for (_, held), n in sizes.items() if held or len(sizes) < 4)

    blank = rows.where("label IS NULL")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__of"))
    again = blank.groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__of")).count().where("count > 1")
    again = saved(again.select("__id", "__of"), "again")
    if not again.isEmpty():
        once = blank.join(again, same, "left_semi").dropDuplicates(["doc_id", "digest"])
        blank = saved(blank.join(again, same, "left_anti").unionByName(once), "blank")
    columns = ["content", "meta", F.coalesce("label", F.lit(-1)).alias("label"), "held"]
    every = known.select(columns).unionByName(blank.withColumn("held", F.lit(False)).select(columns))
    n_known, n_blank = sum(sizes.values()), blank.count()

    def fitted(model: Model | None) -> Model:
        taught, n = (known, n_known) if model is None else (every, n_known + n_blank)
        given = partial(_given, model=model, sure=sure)
        fits = _together([Logistic.asking(), Logistic.asking()], lambda asks: _summed(taught.select(columns), asks, given, 1 + n // TASK_ROWS))
        scores = _held_scores(use, fits)

        def both(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
            label, *views = (c.to_numpy() for c in batch.columns)
            return [(x[:, None], label) for x in views]

        def sums(asks: dict) -> dict:
            return _summed(scores, asks, both, 1 + n_use // (16 * TASK_ROWS))

        curves, most = tuple(_together([_calibrating(), _calibrating()], sums)), float(np.log(n_use + 1))
        found = sums({i: partial(_error, curve=curve, most=most) for i, curve in enumerate(curves)})
        errors = np.array([found[i][0] / n_use + 1e-6 for i in range(2)])
        return Model(*fits, curves, most, tuple((1 / errors / (1 / errors).sum()).tolist()))

    model = fitted(None)
    for _ in range(rounds):
        model = fitted(model)
    return model


def classified(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: float = LEAST, **training) -> DataFrame:
    """(doc_id, digest, p_content, p_meta, score, kept) of every row.

    ``labels`` has the columns doc_id and label (1 good, 0 bad); of several labels of
    an id the lowest counts, and null ids or labels are ignored. p_content and p_meta
    are the calibrated probabilities of either view, score their combination, weighted
    by how well each does on held-out labels. A document is kept from the probability
    ``least``. Without labels of both kinds scores are null and everything is kept.
    Null texts are empty, null languages and sources a value of their own. Repeated
    rows each get a row; an empty table gives none. Other columns are not read.
    """
    text = column(docs, text_col).cast("string")
    names = [column(docs, lang_col).cast("string").alias("lang"), column(docs, source_col).cast("string").alias("source")]
    narrow = docs.select(column(docs, id_col).alias("doc_id"), text_digest(text).alias("digest"), text.alias("text"), *names)
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    # The labels grow with the corpus, so they are never broadcast: one plan for every size.
    rows = saved(features(narrow).join(known.hint("merge"), "doc_id", "left"), "views")
    model = train(rows, **training)
    if model is None:
        none = F.lit(None).cast("double")
        return rows.select("doc_id", "digest", none.alias("p_content"), none.alias("p_meta"), none.alias("score"), F.lit(True).alias("kept"))
    return _scored(rows, model).withColumn("kept", F.col("score") >= least)


def good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the classifier keeps, with all columns. Rows are told apart by id and text."""
    own, of = unused(docs, "__id", "__of")
    bad = classified(docs, labels, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias(own), F.col("digest").alias(of)).distinct()
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(own)) & (text_digest(F.col(f"`{text_col}`").cast("string")) == F.col(of))
    return docs.join(bad, same, "left_anti")
