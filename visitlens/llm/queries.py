"""The registered queries of this package."""

from __future__ import annotations

from visitlens.llm.decontamination import op10
from visitlens.llm.digest_index import op5
from visitlens.llm.hilbert_sharding import op2
from visitlens.llm.hyperminhash import op8
from visitlens.llm.language_id import op1
from visitlens.llm.line_dedup import op6
from visitlens.llm.personal_data import op13
from visitlens.llm.prefix_trie import op11
from visitlens.llm.secret_linking import op3
from visitlens.llm.source_mixing import op7
from visitlens.llm.structure_repair import op12
from visitlens.llm.token_counts import op4
from visitlens.llm.token_frames import op9

QUERIES = {
    "op1_language_id": op1,
    "op2_hilbert_sharding": op2,
    "op3_secret_linking": op3,
    "op4_token_counts": op4,
    "op5_exact_dedup": op5,
    "op6_line_dedup": op6,
    "op7_source_mixing": op7,
    "op8_near_dedup": op8,
    "op9_token_frames": op9,
    "op10_decontamination": op10,
    "op11_prefix_trie": op11,
    "op12_structure_repair": op12,
    "op13_personal_data": op13,
}
