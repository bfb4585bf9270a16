"""The operators over the driver tables, with SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.llm.common import table
from stepforge.llm.line_dedup import dedup_lines
from stepforge.llm.mixing import mix
from stepforge.llm.packing import pack
from stepforge.llm.periodic import periodic_runs
from stepforge.llm.ppm import ppm_scores
from stepforge.llm.quality import quality_scores
from stepforge.llm.sentence_pieces import encode_pieces
from stepforge.llm.simhash import simhash_components
from stepforge.llm.substrings import remove_repeats
from stepforge.llm.topk import top_products
from stepforge.llm.vector_dedup import vector_duplicates
from stepforge.llm.token_counts import token_counts
from stepforge.llm.variants import spelling_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_simhash(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents"))


@query
def op2_pack(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), vocabulary()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), vocabulary())


@query
def op4_line_dedup(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


@query
def op5_top_products(spark, sf_dir):
    return top_products(table(spark, sf_dir, "embeddings"))


@query
def op6_vector_duplicates(spark, sf_dir):
    return vector_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op7_substrings(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_tokens", "weight", "copies")


@query
def op9_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query
def op10_ppm(spark, sf_dir):
    return ppm_scores(table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents, a tenth of them (by checksum of the id) repeating a stretch of words up to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    parts = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words")).selectExpr(
        "doc_id", "text", "words", "h div 10 as g", "size(words) as n")
    parts = parts.selectExpr("*", "if(n > 0, cast(g % n as int), null) as a").selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) as int) as p")
    repeated = F.expr("array_join(concat(slice(words, 1, a), transform(sequence(0, n - a - 1), i -> words[cast(a + i % p as int)])), ' ')")
    return parts.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.expr("""reduce(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (best, run) ->
        if(best is null or run.length * best.period > best.length * run.period, run, best))""")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_sentence_pieces(spark, sf_dir):
    return encode_pieces(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"), drop_one_in=31)
