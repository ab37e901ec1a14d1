"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import benchmark_decontamination as op10
from . import chat_formatting as op4
from . import conversation_repair as op13
from . import hard_negatives as op11
from . import language_id as op3
from . import license_scans as op9
from . import line_dedup as op6
from . import quality_rules as op8
from . import ngram_jaccard as op2
from . import sentencepiece_codec as op5
from . import source_mixing as op12
from . import substring_dedup as op1
from . import url_filters as op7

QUERIES = {
    "op1_substring_dedup": op1.op1_substring_dedup,
    "op2_ngram_jaccard_join": op2.op2_ngram_jaccard_join,
    "op3_language_id": op3.op3_language_id,
    "op4_chat_formatting": op4.op4_chat_formatting,
    "op5_sentencepiece_codec": op5.op5_sentencepiece_codec,
    "op6_line_dedup": op6.op6_line_dedup,
    "op6_line_dedup_short_copies": op6.op6_line_dedup_short_copies,
    "op7_url_filters": op7.op7_url_filters,
    "op8_quality_rules": op8.op8_quality_rules,
    "op9_license_scans": op9.op9_license_scans,
    "op10_benchmark_decontamination": op10.op10_benchmark_decontamination,
    "op11_hard_negatives": op11.op11_hard_negatives,
    "op12_source_mixing": op12.op12_source_mixing,
    "op13_conversation_repair": op13.op13_conversation_repair,
}
SQL = {
    "op1_substring_dedup": op1.SQL,
    "op2_ngram_jaccard_join": op2.SQL,
    "op4_chat_formatting": op4.SQL,
    "op6_line_dedup": op6.SQL,
    "op6_line_dedup_short_copies": op6.SHORT_COPIES_SQL,
    "op10_benchmark_decontamination": op10.SQL,
    "op11_hard_negatives": op11.SQL,
    "op13_conversation_repair": op13.SQL,
}
