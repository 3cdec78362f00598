"""Secrets in documents, and how widely each one is owned across the corpus."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import column, saved, text_digest, unused

#: In this order; ``value`` is the kind that the ownership frequency decides.
KINDS = ("assign", "access", "hex", "value")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_VALUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: Bits a character, and digits, of a value that looks random.
ENTROPY = 3.5
DIGITS = 3
#: A value of more owners is a widely copied example.
OWNERS = 2
#: So is one that any single owner has in more distinct repositories.
REPOSITORIES = 10
MASK = "<secret>"


def entropy(text: str) -> float:
    """Bits a character."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def candidates(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base spans and of other random-looking values, by start and kind."""
    found = [(m.start(), m.end(), "assign", m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access", m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex", m[0]) for m in _HEX.finditer(text)]
    starts, ends = [], []  # of the base spans, those that overlap as one
    for start, end, *_ in sorted(found):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    for m in _VALUE.finditer(text):
        value, at = m[0], bisect_right(ends, m.start())
        apart = at == len(ends) or starts[at] >= m.end()
        if apart and sum(map(str.isdigit, value)) >= DIGITS and any(map(str.isalpha, value)) and entropy(value) >= ENTROPY:
            found.append((m.start(), m.end(), "value", value))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _scan(docs: DataFrame) -> DataFrame:
    """Each row's candidates; a value is only kept as a 128-bit hash."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("hash", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, digests = [], []
            for text in batch.column(4):
                spans = candidates(text.as_py() or "")
                base = ",".join(f"{k}:{s}:{e}" for s, e, k, _ in spans if k != "value")
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                found.append([{"start": s, "end": e, "kind": k, "hash": xxhash.xxh3_128_hexdigest(v)} for s, e, k, v in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.list_(span)), pa.array(digests)], names=["doc_id", "digest", "owner", "repository", "found", "base_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, digest long, owner string, repository string, found array<struct<start:int,end:int,kind:string,hash:string>>, base_sha256 string")


def _pairs(rows: DataFrame) -> DataFrame:
    """(hash, owner, repository, times) of every distinct pair of an owner and a repository that have a value."""
    each = rows.where(F.size("found") > 0).select("repository", "owner", F.explode("found.hash").alias("hash"))
    return each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("times"))


def live(rows: DataFrame, max_owners: int = OWNERS, max_repositories: int = REPOSITORIES) -> DataFrame:
    """(hash) of the values that few owners have, each of them in few repositories."""
    owners = _pairs(rows).groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    values = owners.groupBy("hash").agg(F.count("*").alias("owners"), F.max("repositories").alias("most"))
    return values.where((F.col("owners") <= max_owners) & (F.col("most") <= max_repositories)).select("hash")


def ownership(rows: DataFrame) -> DataFrame:
    """(hash, times, repositories, owners) of every candidate value of the corpus.

    Distinct pairs are formed before they are counted, so a value that a third of all
    rows hold is a few partial sums for each task.
    """
    pairs = _pairs(rows)
    owners = pairs.groupBy("hash", "owner").agg(F.sum("times").alias("times"))
    owners = owners.groupBy("hash").agg(F.sum("times").alias("times"), F.count("*").alias("owners"))
    repositories = pairs.select("hash", "repository").distinct().groupBy("hash").agg(F.count("*").alias("repositories"))
    return owners.join(repositories, "hash").select("hash", "times", "repositories", "owners")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str | None = None, max_owners: int = OWNERS, max_repositories: int = REPOSITORIES) -> DataFrame:
    """(doc_id, digest, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied) of every row.

    Spans of the kinds assign, access and hex are always reported. A further value that
    looks random (kind value) is reported if its hash has at most ``max_owners``
    distinct owners in the corpus and none of them has it in more than
    ``max_repositories`` distinct repositories: then it looks live, while a value of
    more owners, or of more repositories of one owner, is a widely copied example. n_live and n_copied count the reported spans of each sort.
    A document is its own repository unless ``repository_col`` is given. Owners or
    repositories that are null count as one more. Null texts are empty; repeated rows
    each get a row; an empty table gives none. Other columns are not read.
    """
    text = column(docs, text_col).cast("string")
    doc_id = column(docs, id_col).alias("doc_id")
    repository = doc_id if repository_col is None else column(docs, repository_col)
    names = [column(docs, owner_col).cast("string").alias("owner"), repository.cast("string").alias("repository")]
    rows = saved(_scan(docs.select(doc_id, text_digest(text).alias("digest"), *names, text.alias("text"))), "secrets")
    few = live(rows, max_owners, max_repositories)
    keys = ["doc_id", "digest"]
    each = rows.where(F.size("found") > 0).select(*keys, F.explode("found.hash").alias("hash")).distinct()
    own = each.join(few, "hash").groupBy(*keys).agg(F.collect_set("hash").alias("live"))
    own = own.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__of"), "live")
    out = rows.join(own, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__of")), "left")
    out = out.withColumn("live", F.coalesce("live", F.array().cast("array<string>")))
    alive = lambda x: F.array_contains(F.col("live"), x["hash"])
    out = out.withColumn("reported", F.filter("found", lambda x: (x["kind"] != "value") | alive(x)))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    written = F.array_join(F.transform("reported", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    n_live = F.size(F.filter("reported", alive)).cast("long")
    return out.select(*keys, count("assign"), count("access"), count("hex"), "base_sha256", written.alias("spans"), n_live.alias("n_live"), (F.size("reported") - n_live).cast("long").alias("n_copied"))


def masked(text: str, spans: list[tuple[int, int]], mask: str = MASK) -> str:
    """The text with each span, overlapping ones as one, replaced by the mask."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", size_col: str | None = "n_chars", mask: str = MASK) -> DataFrame:
    """The documents, with every reported span replaced by the mask; same columns and rows.

    ``size_col``, if there is one, becomes the new text's number of code points in the
    rows that change.
    """
    own, of, spans = unused(docs, "__id", "__of", "__spans")
    found = scan(docs, id_col, text_col, owner_col).where("spans <> ''").select(F.col("doc_id").alias(own), F.col("digest").alias(of), F.col("spans").alias(spans)).dropDuplicates([own, of])
    text = F.col(f"`{text_col}`")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(own)) & (text_digest(text.cast("string")) == F.col(of))

    @F.pandas_udf("string")
    def mask_all(texts: pd.Series, found: pd.Series) -> pd.Series:
        pairs = zip(texts, found, strict=True)
        return pd.Series([masked(t, [tuple(map(int, x.split(":")[1:])) for x in s.split(",")], mask) if s else t for t, s in pairs], dtype=object)

    joined = docs.join(found, same, "left").withColumn(text_col, mask_all(text, F.col(spans)))
    if size_col is not None and size_col in docs.columns:
        size = F.col(f"`{size_col}`")
        joined = joined.withColumn(size_col, F.when(F.col(spans).isNull(), size).otherwise(F.length(text)).cast(docs.schema[size_col].dataType))
    return joined.drop(own, of, spans)
