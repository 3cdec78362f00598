"""Mixing sources to target weights by weighted sampling without replacement.

A document's key is an exponential draw divided by its quality weight. In the order of
the keys, the first documents of a source are a weighted sample without replacement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowrelay.llm.common import WORD, column, saved, text_digest, unused

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all sizes.
SHARE = 1.5
#: A target is at most so many times its source.
MOST = 2
SYMBOLS = "#*$%&|<>"


def running(frame: DataFrame, group: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    """Adds, for each group in the given order, the sum of each value over the rows before.

    ``values`` names the new columns. The rows are dealt out by ranges of (group,
    order), so a group of any size is summed by many tasks: first within a range, then
    the ranges' totals. Only the totals of one group's ranges meet in one place. Rows
    that tie in all columns of ``order`` may stand in any order. Group columns must
    not be null.
    """
    ranged = frame.repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id())
    held = saved(ranged, "ranges")
    totals = held.groupBy(*group, "__range").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, "__range", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__{n}") for n in values])
    within = Window.partitionBy(*group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = held.join(offsets, [*group, "__range"]).select("*", *[(F.coalesce(F.sum(v).over(within), F.lit(0)) + F.col(f"__{n}")).alias(n) for n, v in values.items()])
    return summed.drop("__range", *[f"__{n}" for n in values])


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(unnamed, source, source_size, target) from (unnamed, source, source_size), one row a source.

    Sources weigh ``weights``, repeating, by code point, the unnamed one last. They
    share ``share`` times all sizes. A target stops at ``most`` times its source's
    size and the excess is shared again by weight until none is above: in the order of
    size to weight, the sources up to some place are full, and the others get the rest
    by weight.
    """
    ranked = running(sizes.withColumn("all", F.lit(0)).withColumn("one", F.lit(1)), ["all"], ["unnamed", "source"], {"rank": "one"})
    list_ = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(list_, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("ratio", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    filled = running(ranked, ["all"], ["ratio", "unnamed", "source"], {"size_before": "source_size", "weight_before": "weight"})
    filled = saved(filled, "filled")
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weights")).first()
    budget, weights_all = share * (whole["size"] or 0), whole["weights"] or 0
    level = (F.lit(budget) - F.lit(most) * F.col("size_before")) / (F.lit(weights_all) - F.col("weight_before"))
    filled = filled.withColumn("full", F.col("ratio") < level)
    rest = filled.where("full").agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weights")).first()
    open_weight = weights_all - (rest["weights"] or 0)
    left = (budget - most * (rest["size"] or 0)) / open_weight if open_weight else 0.0
    target = F.when(F.col("full"), F.lit(float(most)) * F.col("source_size")).otherwise(F.lit(left) * F.col("weight"))
    return filled.select("unnamed", "source", "source_size", F.round(target, 6).alias("target"))


def quality(text: Column) -> Column:
    """A document's quality weight: 1 without symbols, less the more of the text they are."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(F.lit(1.0) / (F.lit(1.0) + F.lit(100.0) * symbols / F.greatest(F.length(text), F.lit(1))), F.lit(1.0))


def draw(seed: int, *parts: Column) -> Column:
    """A number between 0 and 1, both excluded, from the seed and the parts alone."""
    named = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(named), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 7, marked: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row; ``marked`` adds the text's digest.

    size counts a text's words (null: 0). taken is how many words the mix takes, repeats
    counted: first whole epochs, as many as the target holds, then, in the order of the
    keys, documents until the rest of the target is used up; the last one is cut there,
    so a source's taken words are its target, rounded down. ``weight`` is the quality
    weight (positive; null or less counts as 1); by default the text's.

    Draws depend on the seed and the id alone, so reruns agree. Rows with one id share
    a draw and are ordered by size. Null sources are one source, after all others. Rows
    without words are taken 0 times. An empty table gives no rows. Other columns are
    not read.
    """
    text = column(docs, text_col).cast("string")
    source = column(docs, source_col).cast("string")
    doc_id = column(docs, id_col)
    given = quality(text) if weight is None else weight
    heavy = F.when(given > 0, given).otherwise(1.0)
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    key = -F.log(draw(seed, doc_id)) / heavy
    rows = docs.select(doc_id.alias("doc_id"), source.isNull().alias("unnamed"), F.coalesce(source, F.lit("")).alias("source"), size.alias("size"), key.alias("key"), *([text_digest(text).alias("digest")] if marked else []))
    group = ["unnamed", "source"]
    rows = saved(rows, "drawn")  # dealing out by ranges samples its input, which would read the texts twice
    rows = saved(running(rows, group, ["key", "doc_id", "size"], {"before": "size"}), "keys")
    goals = targets(rows.groupBy(*group).agg(F.sum("size").alias("source_size")), weights, share, most)
    rows = rows.join(goals, group)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - epochs * F.col("source_size")) - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    name = F.when(~F.col("unnamed"), F.col("source"))
    return rows.select("doc_id", name.alias("source"), "size", "source_size", "target", taken.cast("long").alias("taken"), *(["digest"] if marked else []))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents that the mix takes words of: all columns, and size, source_size, target and taken.

    The figures are :func:`mix`'s; a column of the documents with one of their names gives
    way. Rows are told apart by id, also a null one, and text; a repeated row is
    returned once, with all its copies' taken words.
    """
    figures = ["size", "source_size", "target", "taken"]
    found = mix(docs, id_col, text_col, source_col, marked=True, **options)
    own, of = unused(docs, "__id", "__of")
    alike = found.groupBy(F.col("doc_id").alias(own), F.col("digest").alias(of))
    sums = alike.agg(*[F.max(c).alias(c) for c in figures[:3]], F.sum("taken").alias("taken"), F.count("*").alias("copies")).where("taken > 0")
    sums = saved(sums, "taken")
    rows = docs.drop(*figures)

    def joined(some: DataFrame) -> DataFrame:
        same = column(rows, id_col).eqNullSafe(F.col(own)) & (text_digest(column(rows, text_col).cast("string")) == F.col(of))
        return rows.join(some.drop("copies"), same)

    again = sums.where("copies > 1")
    out = joined(sums.where("copies = 1"))
    if not again.isEmpty():
        out = out.unionByName(joined(again).dropDuplicates([own, of]))
    return out.drop(own, of)
