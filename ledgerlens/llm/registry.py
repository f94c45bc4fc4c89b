"""The queries of the training-data operators."""

from __future__ import annotations

from . import bpe, canonical, exact_dedup, language, lm_scoring, packing, pii, sharding, simhash, warc

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_warc": warc.op3_warc,
    "op4_canonical": canonical.op4_canonical,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_packing": packing.op6_packing,
    "op7_simhash": simhash.op7_simhash,
    "op8_pii": pii.op8_pii,
    "op9_language": language.op9_language,
    "op10_bpe": bpe.op10_bpe,
}
ORACLES = {"op3_warc": warc.ORACLE_SQL, "op5_exact_dedup": exact_dedup.ORACLE_SQL}
