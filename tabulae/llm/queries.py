"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.llm import language, quality_model
from tabulae.llm.collocations import mine_collocations
from tabulae.llm.common import fold, read
from tabulae.llm.decontaminate import find_contamination
from tabulae.llm.licences import scan_licences
from tabulae.llm.line_dedup import deduplicate_lines
from tabulae.llm.ngram_join import join_documents
from tabulae.llm.oracles import COLLOCATIONS, DECONTAMINATE, LINE_DEDUP, QUALITY_RULES, SEARCH
from tabulae.llm.packing import pack_documents
from tabulae.llm.pii import replace_personal_data
from tabulae.llm.quality_rules import judge_documents
from tabulae.llm.search import search_documents
from tabulae.llm.secrets import scan_secrets
from tabulae.llm.sharding import shard_documents


def op1_quality(spark, sf_dir):
    scored = quality_model.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.withColumns({
        "held_out": F.coalesce(fold("doc_id", quality_model.FOLDS) == quality_model.HELD_OUT, F.lit(False)),
        "predicted": (F.col("score") >= quality_model.THRESHOLD).cast("int")})


def op2_decontaminate(spark, sf_dir):
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("spans")


def op3_quality_rules(spark, sf_dir):
    return judge_documents(read(spark, sf_dir, "documents")).drop("cleaned")


def op4_language(spark, sf_dir):
    return language.identify_languages(read(spark, sf_dir, "documents")).drop("proportions").withColumn(
        "held_out", F.coalesce(fold("doc_id", language.FOLDS) == language.HELD_OUT, F.lit(False)))


def op5_pack(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"))


def op6_secrets(spark, sf_dir):
    return scan_secrets(read(spark, sf_dir, "documents"))


def op7_pii(spark, sf_dir):
    return replace_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_licences(spark, sf_dir):
    return scan_licences(read(spark, sf_dir, "documents"))


def op9_shard(spark, sf_dir):
    return shard_documents(read(spark, sf_dir, "documents")).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op10_ngram_join(spark, sf_dir):
    return join_documents(read(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return mine_collocations(read(spark, sf_dir, "documents"))


def op12_line_dedup(spark, sf_dir):
    return deduplicate_lines(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_search(spark, sf_dir):
    return search_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_decontaminate, op3_quality_rules, op4_language, op5_pack, op6_secrets,
    op7_pii, op8_licences, op9_shard, op10_ngram_join,
    op11_collocations, op12_line_dedup, op13_search)}
SQL: dict[str, str] = {
    "op2_decontaminate": DECONTAMINATE, "op3_quality_rules": QUALITY_RULES, "op11_collocations": COLLOCATIONS,
    "op12_line_dedup": LINE_DEDUP, "op13_search": SEARCH}
