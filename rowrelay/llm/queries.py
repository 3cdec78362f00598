"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowrelay.llm import cotraining, decontaminate, divergence, licenses, likelihood, mixture, onebit, periodic, secrets, simhash, templates, toolcalls, warc
from rowrelay.llm.common import WORD


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    names = F.array_join(F.array_distinct(F.transform("matches", lambda m: m["license"])), ",")
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0))
    return found.select("doc_id", "n_units", F.size("matches").cast("long").alias("n_matches"), names.alias("licenses"), best.alias("best_dice"))


def op2_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.derivatives(warc.responses(table(spark, folder, "pages")))
    return found.withColumn("header_sha256", F.sha2("header", 256)).drop("header", "block")


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


def quality_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))


def op5_cotrained_quality(spark: SparkSession, folder: str) -> DataFrame:
    return cotraining.classified(table(spark, folder, "documents"), quality_labels(spark, folder)).drop("digest")


def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix(table(spark, folder, "documents"))


def op7_site_templates(spark: SparkSession, folder: str) -> DataFrame:
    return templates.extracted(table(spark, folder, "pages"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents")).drop("digest")


def op9_tool_call_linking(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = toolcalls.exchanges(table(spark, folder, "conversations"))
    found = toolcalls.linked(calls, results, toolcalls.REPLY)
    return found.withColumn("json_sha256", F.sha2("json", 256)).drop("json")


def op10_likelihood_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return likelihood.judged(table(spark, folder, "documents"), trusted)


def op11_onebit_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return onebit.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """The documents; every tenth by the checksum of its id repeats words from some place on."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(code / 10).cast("int")

    def repeated(words):
        n = F.size(words)
        a = F.pmod(g, n)
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        again = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(again), F.lit(1), n - a)), " ")

    # The words are bound by a function, as each step would take them out of the text again.
    found = F.array(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    new = F.transform(found, lambda words: F.when(F.size(words) > 0, repeated(words)))[0]
    return docs.withColumn("text", F.when(code % 10 == 0, F.coalesce(new, "text")).otherwise(F.col("text")))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.strongest(periodic.runs(planted_runs(table(spark, folder, "documents"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in globals().items() if name.startswith("op")]
    return {f.__name__: f for f in found}
