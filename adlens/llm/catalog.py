"""The registered queries of this package and their SQL, where SQL can say it."""

from __future__ import annotations

from adlens.llm import (decontamination, jaccard, manifest, packing, pii, quality, repeats,
                        resampling, secret_scan, sharding, simhash, topk, urls)

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_suffix_dedup": repeats.op3_suffix_dedup,
    "op4_url_filter": urls.op4_url_filter,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_quality": quality.op7_quality,
    "op8_top_k": topk.op8_top_k,
    "op9_pii": pii.op9_pii,
    "op10_sharding": sharding.op10_sharding,
    "op11_simhash": simhash.op11_simhash,
    "op12_resampling": resampling.op12_resampling,
    "op13_manifest": manifest.op13_manifest,
}

ORACLE_SQL = {"op8_top_k": topk.OP8_SQL, "op12_resampling": resampling.OP12_SQL,
              "op13_manifest": manifest.OP13_SQL}
