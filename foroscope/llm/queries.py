"""Queries of the training-data operators over the test tables, each with its SQL where one exists."""

import corpus_pipeline
from foroscope.llm import (chaining, decontaminate, exact, langid, lines, merkle, mixing, pii, projections, quality,
                           search, simhash, suffixes)
from foroscope.llm.common import documents

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, fn, sql: str | None = None) -> None:
    QUERIES[name] = fn
    if sql:
        ORACLES[name] = sql.strip()


register("op1_simhash_groups", lambda spark, d: simhash.simhash_groups(documents(spark, d)))
register("op2_source_mix", lambda spark, d: mixing.source_mix(documents(spark, d)), mixing.ORACLE)
register("op3_shared_passages", lambda spark, d: chaining.shared_passages(documents(spark, d)))
register("op4_benchmark_overlap", lambda spark, d: decontaminate.benchmark_overlap(
    documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")), decontaminate.ORACLE)
register("op5_personal_data", lambda spark, d: pii.find_personal_data(documents(spark, d)))
register("op6_repeated_bytes", lambda spark, d: suffixes.repeated_bytes(documents(spark, d)))
register("op7_languages", lambda spark, d: langid.languages(documents(spark, d)))
register("op8_near_vectors", lambda spark, d: projections.near_vectors(spark.read.parquet(f"{d}/embeddings.parquet")))
register("op9_quality", lambda spark, d: quality.classify(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")))
register("op10_line_dedup", lambda spark, d: lines.line_dedup(documents(spark, d)), lines.ORACLE)
register("op11_merkle_manifest", lambda spark, d: merkle.merkle_manifest(documents(spark, d)), merkle.ORACLE)
register("op12_exact_dedup", lambda spark, d: exact.exact_dedup(documents(spark, d)), exact.ORACLE)
register("op13_ranked_search", lambda spark, d: search.ranked_search(
    documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")), search.ORACLE)
register("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
