"""The subpackage's queries and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from gossamr.llm.byte_bpe import op7_byte_bpe
from gossamr.llm.chat_format import OP12_SQL, op12_chat_format
from gossamr.llm.licenses import op2_licenses
from gossamr.llm.line_dedup import OP9_SQL, op9_line_dedup
from gossamr.llm.lm_scoring import OP10_SQL, op10_lm_scoring
from gossamr.llm.log_replay import OP11_SQL, op11_log_replay
from gossamr.llm.order_minhash import op5_fingerprints
from gossamr.llm.packing import op3_packing
from gossamr.llm.parity_join import OP6_SQL, op6_jaccard_join
from gossamr.llm.pii import op1_pii
from gossamr.llm.quality_rules import op8_quality_rules
from gossamr.llm.spelling import OP13_SQL, op13_spelling
from gossamr.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_pii": op1_pii,
    "op2_licenses": op2_licenses,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_fingerprints": op5_fingerprints,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_line_dedup": op9_line_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_log_replay": op11_log_replay,
    "op12_chat_format": op12_chat_format,
    "op13_spelling": op13_spelling,
}
ORACLES = {
    "op4_warc": OP4_SQL,
    "op6_jaccard_join": OP6_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_lm_scoring": OP10_SQL,
    "op11_log_replay": OP11_SQL,
    "op12_chat_format": OP12_SQL,
    "op13_spelling": OP13_SQL,
}
