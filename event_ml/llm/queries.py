"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from event_ml.llm import alignment, decontaminate, language_id, licenses, line_dedup, maxent_lm, merkle, multiset_hash, packing, separators, simhash, url_rules, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_separator_scan": separators.op1_separator_scan,
    "op2_hashed_maxent": maxent_lm.op2_hashed_maxent,
    "op3_association_rules": url_rules.op3_association_rules,
    "op4_multiset_hash": multiset_hash.op4_multiset_hash,
    "op5_spaced_seeds": decontaminate.op5_spaced_seeds,
    "op6_simhash_pivot_tables": simhash.op6_simhash_pivot_tables,
    "op7_line_suffix_array": line_dedup.op7_line_suffix_array,
    "op8_cost_balanced_packing": packing.op8_cost_balanced_packing,
    "op9_byte_cnn": language_id.op9_byte_cnn,
    "op10_warc_zstd": warc.op10_warc_zstd,
    "op11_merkle_climb": merkle.op11_merkle_climb,
    "op12_exact_dedup_alignment": alignment.op12_exact_dedup_alignment,
    "op13_template_markup": licenses.op13_template_markup,
}

ORACLE_SQL: dict[str, str] = {"op10_warc_zstd": warc.OP10_SQL, "op11_merkle_climb": merkle.OP11_SQL}
