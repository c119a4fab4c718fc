"""The queries of the language-model data operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from rasterloom.llm import credentials, decontam, langid, lm, mixing, neardup, quality, store, toxicity, warczip


def queries() -> dict[str, Callable]:
    return {
        "op1_deleted_interpolation": lm.op1_deleted_interpolation,
        "op2_suffix_decontam": decontam.op2_suffix_decontam,
        "op3_ipf_mix": mixing.op3_ipf_mix,
        "op4_bbit_minhash": neardup.op4_bbit_minhash,
        "op5_content_store": store.op5_content_store,
        "op6_quality_rules": quality.op6_quality_rules,
        "op7_ppm_langid": langid.op7_ppm_langid,
        "op8_weak_toxicity": toxicity.op8_weak_toxicity,
        "op9_zip_warc": warczip.op9_zip_warc,
        "op10_credential_links": credentials.op10_credential_links,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_suffix_decontam": decontam.ORACLE,
        "op3_ipf_mix": mixing.ORACLE,
        "op4_bbit_minhash": neardup.ORACLE,
        "op6_quality_rules": quality.ORACLE,
        "op9_zip_warc": warczip.ORACLE,
        "op10_credential_links": credentials.ORACLE,
    }
