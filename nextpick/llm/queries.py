"""Queries of this subpackage by name, and SQL where it can express them."""

from __future__ import annotations

import corpus_pipeline
from nextpick.llm import (caps, decontaminate, fingerprint, language, manifest, mixing, packing, pii, quality, search,
                          secret_scan, simhash, urls)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_language": language.op2_language,
    "op3_quality": quality.op3_quality,
    "op4_urls": urls.op4_urls,
    "op5_secrets": secret_scan.op5_secrets,
    "op6_mixing": mixing.op6_mixing,
    "op7_fingerprints": fingerprint.op7_fingerprints,
    "op8_simhash": simhash.op8_simhash,
    "op9_caps": caps.op9_caps,
    "op10_packing": packing.op10_packing,
    "op11_manifest": manifest.op11_manifest,
    "op12_decontamination": decontaminate.op12_decontamination,
    "op13_search": search.op13_search,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {"op4_urls": urls.ORACLE, "op11_manifest": manifest.ORACLE, "op12_decontamination": decontaminate.ORACLE,
          "op13_search": search.ORACLE}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
