"""The operators of this subpackage as queries over the supplied tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    conversations,
    decontamination,
    html_text,
    line_dedup,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentencepiece,
    simhash,
    url_filter,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Where the vocabulary file of the queries is.
PIECES = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


#: Where the byte-level BPE file of the queries is.
BYTE_PIECES = os.environ.get("BYTE_BPE_FILE", "/opt/tokenizers/byte_bpe_50k.json")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_sentencepiece(spark, sf):
    return sentencepiece.round_trip(table(spark, sf, "documents"), PIECES)


@query
def op2_line_dedup(spark, sf):
    rows = line_dedup.duplicate_lines(table(spark, sf, "documents"))
    return rows.select("doc_id", "line_no", "component_id", "kept_doc_id", "kept_line_no", "kept")


@query
def op3_decontamination(spark, sf):
    rows = decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op4_simhash(spark, sf):
    rows = simhash.near_duplicates(table(spark, sf, "documents"), width=4, distance=4)
    return rows.select("doc_id", "fingerprint", "component_id")


@query
def op5_secret_scan(spark, sf):
    rows = secret_scan.secret_report(table(spark, sf, "documents"))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op6_quality_classifier(spark, sf):
    return quality_classifier.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op7_warc(spark, sf):
    return warc.archive_pages(table(spark, sf, "pages"))


@query
def op8_url_filter(spark, sf):
    model = url_filter.train(url_filter.labelled_table(spark))
    return url_filter.judge_urls(table(spark, sf, "pages"), model)


@query
def op9_html_text(spark, sf):
    return html_text.main_text(table(spark, sf, "pages"))


@query
def op10_quality_rules(spark, sf):
    rows = quality_rules.judge(quality_rules.ledger(table(spark, sf, "documents")))
    failed = F.col("failed_bits").bitwiseAND(F.lit(quality_rules.POLICIES["base"])) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "kept", "failed_bits",
    )


@query
def op11_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), BYTE_PIECES)


@query
def op12_conversation_repair(spark, sf):
    return conversations.damaged_report(table(spark, sf, "conversations"))


@query
def op13_periodic_runs(spark, sf):
    return periodic_runs.run_report(periodic_runs.plant_runs(table(spark, sf, "documents")))
