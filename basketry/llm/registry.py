"""Registered queries of the corpus operators."""

from __future__ import annotations

from basketry.llm import align, collocations, decontaminate, fingerprint, jaccard, langid, lm
from basketry.llm import pii, repeats, sharding, spm, tokencache, warc

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_pii_weak_supervision": pii.op2_pii_weak_supervision,
    "op3_jaccard_join": jaccard.op3_jaccard_join,
    "op4_warc_revisits": warc.op4_warc_revisits,
    "op5_repeats": repeats.op5_repeats,
    "op6_kd_sharding": sharding.op6_kd_sharding,
    "op7_language_id": langid.op7_language_id,
    "op8_fingerprint": fingerprint.op8_fingerprint,
    "op9_sentencepiece": spm.op9_sentencepiece,
    "op10_lm_score": lm.op10_lm_score,
    "op11_collocations": collocations.op11_collocations,
    "op12_token_counts": tokencache.op12_token_counts,
    "op13_alignment": align.op13_alignment,
}

ORACLE: dict[str, str] = {
    "op4_warc_revisits": warc.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
}
