"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantwise.llm import centroid_clustering, embedding_dedup, host_rules, ranked_search, substring_dedup, suffix_dedup, warc, winnowing
from plantwise.llm.common import read_table
from plantwise.llm.packing import pack
from plantwise.llm.simhash import simhash_groups
from plantwise.llm.site_quality import site_quality
from plantwise.llm.token_counts import token_counts
from plantwise.llm.token_files import token_files


def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"))


def op3_simhash(spark, sf_dir):
    return simhash_groups(read_table(spark, sf_dir, "documents"))


def op4_token_files(spark, sf_dir):
    return token_files(read_table(spark, sf_dir, "documents"))


def op5_site_quality(spark, sf_dir):
    return site_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_token_counts(spark, sf_dir):
    return token_counts(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    out = host_rules.quality_rules(read_table(spark, sf_dir, "documents"))
    return out.withColumn("host_rate", F.floor(F.col("host_rate") * 1e6 + 0.5) / 1e6)


def op8_decontamination(spark, sf_dir):
    return winnowing.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_warc(spark, sf_dir):
    return warc.warc_round_trip(read_table(spark, sf_dir, "pages"))


def op10_packing(spark, sf_dir):
    return pack(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark, sf_dir):
    return ranked_search.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_embedding_dedup(spark, sf_dir):
    return embedding_dedup.embedding_dedup(read_table(spark, sf_dir, "embeddings"))


def op13_centroid_clustering(spark, sf_dir):
    return centroid_clustering.centroid_clustering(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_suffix_dedup, op3_simhash, op4_token_files, op5_site_quality, op6_token_counts, op7_quality_rules, op8_decontamination, op9_warc, op10_packing,
                                   op11_ranked_search, op12_embedding_dedup, op13_centroid_clustering)}

#: DuckDB text of the queries that SQL can express.
ORACLE: dict[str, str] = {"op1_substring_dedup": substring_dedup.ORACLE, "op2_suffix_dedup": suffix_dedup.ORACLE, "op7_quality_rules": host_rules.ORACLE, "op8_decontamination": winnowing.ORACLE, "op9_warc": warc.ORACLE,
                          "op11_ranked_search": ranked_search.ORACLE, "op12_embedding_dedup": embedding_dedup.ORACLE, "op13_centroid_clustering": centroid_clustering.ORACLE}
