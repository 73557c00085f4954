"""Registry of the operators' queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from tierwise.llm import (
    collocations,
    host_rules,
    jaccard_join,
    lang_id,
    license_scan,
    lm_score,
    mixing,
    oracle,
    packing,
    quality_crf,
    secret_scan,
    simhash,
    substring_dedup,
    whitening,
)


def _pipeline(spark, sf_dir):
    import corpus_pipeline  # at the repository's top

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {
        "pipeline": _pipeline,
        "op1_lm_score": lm_score.op1_lm_score,
        "op2_simhash": simhash.op2_simhash,
        "op3_quality_crf": quality_crf.op3_quality_crf,
        "op4_mixing": mixing.op4_mixing,
        "op5_jaccard_join": jaccard_join.op5_jaccard_join,
        "op6_lang_id": lang_id.op6_lang_id,
        "op7_secret_scan": secret_scan.op7_secret_scan,
        "op8_license_scan": license_scan.op8_license_scan,
        "op9_packing": packing.op9_packing,
        "op10_host_rules": host_rules.op10_host_rules,
        "op11_whitening": whitening.op11_whitening,
        "op12_collocations": collocations.op12_collocations,
        "op13_substring_dedup": substring_dedup.op13_substring_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
