"""Registered queries of this package: opN_<name> and the pipeline."""

from __future__ import annotations

from stationlake.llm.op1_license import op1_license_scans
from stationlake.llm.op2_quality import op2_quality_rules
from stationlake.llm.op3_sentencepiece import op3_sentencepiece
from stationlake.llm.op4_decontaminate import op4_decontamination
from stationlake.llm.op5_toxicity import op5_toxicity
from stationlake.llm.op6_minhash import op6_minhash
from stationlake.llm.op7_warc import op7_warc
from stationlake.llm.op8_interpolation import op8_lm_scoring
from stationlake.llm.op9_token_shards import op9_token_shards
from stationlake.llm.op10_line_dedup import op10_line_dedup
from stationlake.llm.op11_packing import op11_packing
from stationlake.llm.op12_centroids import op12_centroids
from stationlake.llm.op13_resampling import op13_resampling
from stationlake.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_quality_rules": op2_quality_rules,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_minhash": op6_minhash,
    "op7_warc": op7_warc,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_shards": op9_token_shards,
    "op10_line_dedup": op10_line_dedup,
    "op11_packing": op11_packing,
    "op12_centroids": op12_centroids,
    "op13_resampling": op13_resampling,
}
