"""The operators' registered queries and, where SQL expresses them, their DuckDB SQL."""

from __future__ import annotations

from statmart.llm.bpe import op10_bpe
from statmart.llm.chatlog import op5_chat_format
from statmart.llm.decontaminate import op8_spaced_seeds
from statmart.llm.kmeans_tree import op4_kmeans_tree
from statmart.llm.langid import op3_language_id
from statmart.llm.linededup import op6_line_dedup
from statmart.llm.ngram_join import op7_ngram_join
from statmart.llm.ranked_search import OP11_SQL, op11_geometric_blocks
from statmart.llm.revisits import OP1_SQL, op1_revisits
from statmart.llm.sharding import op9_feistel_sharding
from statmart.llm.simhash import op13_covering_simhash
from statmart.llm.tokenfile import op2_bitplane_files
from statmart.llm.whitening import op12_spectrum_whitening

QUERIES = {
    "op1_revisits": op1_revisits,
    "op2_bitplane_files": op2_bitplane_files,
    "op3_language_id": op3_language_id,
    "op4_kmeans_tree": op4_kmeans_tree,
    "op5_chat_format": op5_chat_format,
    "op6_line_dedup": op6_line_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_spaced_seeds": op8_spaced_seeds,
    "op9_feistel_sharding": op9_feistel_sharding,
    "op10_bpe": op10_bpe,
    "op11_geometric_blocks": op11_geometric_blocks,
    "op12_spectrum_whitening": op12_spectrum_whitening,
    "op13_covering_simhash": op13_covering_simhash,
}

ORACLE: dict[str, str] = {
    "op1_revisits": OP1_SQL,
    "op11_geometric_blocks": OP11_SQL,
}
