"""Registered queries of this folder: name -> (query, DuckDB twin or None)."""

from __future__ import annotations

from plumbline.llm import (
    ann,
    bpe,
    collocations,
    langid,
    license_scan,
    near_dup,
    packing,
    quality_model,
    quality_rules,
    repeats,
    secrets_scan,
    vector_codes,
    warc,
)


def queries() -> dict:
    return {
        "op1_ppm_language_id": (langid.query, None),
        "op2_llr_quality_rules": (quality_rules.query, None),
        "op3_entropy_secret_scan": (secrets_scan.query, None),
        "op4_prefix_dp_bpe": (bpe.query, None),
        "op5_hamming_near_dup": (near_dup.query, None),
        "op6_swap_packing": (packing.query, None),
        "op7_mil_quality": (quality_model.query, None),
        "op8_license_digest": (license_scan.query, license_scan.ORACLE_SQL),
        "op9_warc_chunks": (warc.query, None),
        "op10_posting_list_ann": (ann.query, None),
        "op11_cover_tree_codes": (vector_codes.query, vector_codes.ORACLE_SQL),
        "op12_prefix_tree_collocations": (collocations.query, collocations.ORACLE_SQL),
        "op13_interval_tree_dedup": (repeats.query, repeats.ORACLE_SQL),
    }
