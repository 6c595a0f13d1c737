"""The registered queries of the llm operators and their DuckDB oracles."""

from .chat import OP10_SQL, op10_perspective_rotation
from .class_lm import op9_class_ngram_score
from .histogram_packing import op11_pack_by_histogram
from .language import op6_language_ppm
from .lexical import OP12_SQL, op12_mask_search
from .merkle import OP13_SQL, op13_merkle_manifest
from .mixing import OP2_SQL, op2_mix_sources
from .near_dup import op1_minmax_near_dup
from .packing import op8_pack_best_fit
from .pii import op4_pii_semi_crf
from .quality import op7_quality_weak_supervision
from .token_counts import op5_token_counts
from .topk import OP3_SQL, op3_bit_sliced_topk

QUERIES = {
    "op1_minmax_near_dup": op1_minmax_near_dup,
    "op3_bit_sliced_topk": op3_bit_sliced_topk,
    "op4_pii_semi_crf": op4_pii_semi_crf,
    "op5_token_counts": op5_token_counts,
    "op6_language_ppm": op6_language_ppm,
    "op7_quality_weak_supervision": op7_quality_weak_supervision,
    "op8_pack_best_fit": op8_pack_best_fit,
    "op9_class_ngram_score": op9_class_ngram_score,
    "op10_perspective_rotation": op10_perspective_rotation,
    "op2_mix_sources": op2_mix_sources,
    "op11_pack_by_histogram": op11_pack_by_histogram,
    "op12_mask_search": op12_mask_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op2_mix_sources": OP2_SQL,
    "op3_bit_sliced_topk": OP3_SQL,
    "op10_perspective_rotation": OP10_SQL,
    "op12_mask_search": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
