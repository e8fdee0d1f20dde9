"""Registered queries of the subpackage: name -> (run(spark, sf_dir), DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martkit.llm import (
    chat_format,
    decontaminate,
    fingerprint,
    importance,
    language_id,
    line_dedup,
    ngram_join,
    page_text,
    secret_ledger,
    spelling,
    suffix_dedup,
    text_mix,
    turn_repair,
)

TRICKY = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_importance_resample(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels")
    return importance.importance_resample(_table(spark, sf_dir, "documents"), labels, size_of_target=True)


def op2_language_id(spark, sf_dir):
    return language_id.identify_languages(_table(spark, sf_dir, "documents"))


def op3_chat_format(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"SELECT -7L AS conv_id, turn, role, '{TRICKY}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return chat_format.chat_digest(rows.unionByName(extra))


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeated_spans(_table(spark, sf_dir, "documents"))


def op5_ngram_join(spark, sf_dir):
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op6_mix_sources(spark, sf_dir):
    return text_mix.mix_sources(_table(spark, sf_dir, "documents"))


def op7_secret_ledger(spark, sf_dir):
    return secret_ledger.secret_digest(_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "lines_in", "lines_removed")


def op9_fingerprint(spark, sf_dir):
    return fingerprint.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark, sf_dir):
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), damage=199)


def op12_repair_turns(spark, sf_dir):
    return turn_repair.repair_damaged(_table(spark, sf_dir, "conversations"))


def op13_page_text(spark, sf_dir):
    return page_text.extract_pages(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {
    "op1_importance_resample": (op1_importance_resample, None),
    "op2_language_id": (op2_language_id, None),
    "op3_chat_format": (op3_chat_format, chat_format.SQL),
    "op4_suffix_dedup": (op4_suffix_dedup, None),
    "op5_ngram_join": (op5_ngram_join, ngram_join.SQL),
    "op6_mix_sources": (op6_mix_sources, text_mix.SQL),
    "op7_secret_ledger": (op7_secret_ledger, secret_ledger.SQL),
    "op8_line_dedup": (op8_line_dedup, line_dedup.SQL),
    "op9_fingerprint": (op9_fingerprint, None),
    "op10_decontaminate": (op10_decontaminate, decontaminate.SQL),
    "op11_spelling_variants": (op11_spelling_variants, spelling.SQL),
    "op12_repair_turns": (op12_repair_turns, turn_repair.SQL),
    "op13_page_text": (op13_page_text, page_text.SQL),
}
