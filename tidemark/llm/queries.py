"""Registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from .chat_format import OP3_SQL, op3_chat_format
from .embedding_dedup import OP1_SQL, op1_embedding_dedup
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .language_id import op6_language_id
from .packing import op7_best_fit_packing
from .piece_codec import op4_piece_codec
from .ppm_scoring import op10_ppm_scoring
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .quality_rules import OP9_SQL, op9_quality_rules
from .sharding import OP11_SQL, op11_sharding
from .simhash_dedup import op2_simhash_dedup
from .substring_dedup import OP8_SQL, op8_substring_dedup
from .warc import OP5_SQL, op5_warc

QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_piece_codec": op4_piece_codec,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_ppm_scoring": op10_ppm_scoring,
    "op11_sharding": op11_sharding,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE = {
    "op1_embedding_dedup": OP1_SQL,
    "op3_chat_format": OP3_SQL,
    "op5_warc": OP5_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op9_quality_rules": OP9_SQL,
    "op11_sharding": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
