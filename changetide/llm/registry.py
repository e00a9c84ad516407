"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .attention import op3_attention_scores
from .bpe import op9_bpe
from .codes import op13_vector_codes
from .infill import OP12_SQL, op12_infill
from .jaccard import op8_jaccard_join
from .language import op1_page_languages
from .lines import OP11_SQL, op11_line_dedup
from .mixing import op5_mixed_rates
from .order_minhash import op7_order_minhash
from .packing import op2_packed_rows
from .repeats import op10_repeated_strings
from .sharding import op6_jump_shards
from .vectors import op4_near_vectors

QUERIES = {
    "op1_page_languages": op1_page_languages,
    "op2_packed_rows": op2_packed_rows,
    "op3_attention_scores": op3_attention_scores,
    "op4_near_vectors": op4_near_vectors,
    "op5_mixed_rates": op5_mixed_rates,
    "op6_jump_shards": op6_jump_shards,
    "op7_order_minhash": op7_order_minhash,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_bpe": op9_bpe,
    "op10_repeated_strings": op10_repeated_strings,
    "op11_line_dedup": op11_line_dedup,
    "op12_infill": op12_infill,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {"op11_line_dedup": OP11_SQL, "op12_infill": OP12_SQL}
