"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from annuity.llm import (hard_negatives, inner_product, language_id, license_scan, mixing, packing, quality_classifier,
                         ranked_search, rule_ledger, sharding, simhash, token_counts, toxicity)
from annuity.llm.common import read_table


def op1_best_fit_packing(spark, sf_dir):
    return packing.op1(read_table(spark, sf_dir, "documents"))


def op2_sharding(spark, sf_dir):
    return sharding.op2(read_table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark, sf_dir):
    return simhash.op3(read_table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark, sf_dir):
    return inner_product.op4(read_table(spark, sf_dir, "embeddings"))


def op5_quality_classifier(spark, sf_dir):
    return quality_classifier.op5(spark, sf_dir)


def op6_license_scans(spark, sf_dir):
    return license_scan.op6(read_table(spark, sf_dir, "documents"))


def op7_mixing_sources(spark, sf_dir):
    return mixing.op7(read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    return toxicity.op8(spark, sf_dir)


def op9_language_id(spark, sf_dir):
    return language_id.op9_table(spark, sf_dir)


def op10_quality_rules(spark, sf_dir):
    return rule_ledger.op10(read_table(spark, sf_dir, "documents"))


def op11_token_counts(spark, sf_dir):
    return token_counts.op11(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.op12(read_table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark, sf_dir):
    return ranked_search.op13(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_sharding": op2_sharding,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_license_scans": op6_license_scans,
    "op7_mixing_sources": op7_mixing_sources,
    "op8_toxicity": op8_toxicity,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
    "op11_token_counts": op11_token_counts,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ranked_search": op13_ranked_search,
}


def oracle_queries() -> dict[str, str]:
    return {
        "op2_sharding": sharding.op2_sql(),
        "op4_exact_top_k": inner_product.op4_sql(),
        "op6_license_scans": license_scan.op6_sql(),
        "op10_quality_rules": rule_ledger.op10_sql(),
        "op12_hard_negatives": hard_negatives.op12_sql(),
        "op13_ranked_search": ranked_search.op13_sql(),
    }
