"""The queries of this folder, and SQL where SQL can state the same rows."""

from __future__ import annotations

from loomgraph.llm.bpe import op7_bpe_roundtrip
from loomgraph.llm.chat import OP10_SQL, op10_chat_rotation
from loomgraph.llm.decontaminate import OP9_SQL, op9_decontaminate
from loomgraph.llm.jaccard_join import OP1_SQL, op1_ngram_jaccard
from loomgraph.llm.neighbours import op8_hash_prefix_forest
from loomgraph.llm.ngram_lm import op5_ngram_score
from loomgraph.llm.pii import op4_pii
from loomgraph.llm.quality import op3_quality_resample
from loomgraph.llm.substring_dedup import OP6_SQL, op6_substring_dedup
from loomgraph.llm.url_rules import OP2_SQL, op2_url_filter

QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_url_filter": op2_url_filter,
    "op3_quality_resample": op3_quality_resample,
    "op4_pii": op4_pii,
    "op5_ngram_score": op5_ngram_score,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_bpe_roundtrip": op7_bpe_roundtrip,
    "op8_hash_prefix_forest": op8_hash_prefix_forest,
    "op9_decontaminate": op9_decontaminate,
    "op10_chat_rotation": op10_chat_rotation,
}

ORACLES: dict[str, str] = {"op1_ngram_jaccard": OP1_SQL, "op2_url_filter": OP2_SQL, "op6_substring_dedup": OP6_SQL, "op9_decontaminate": OP9_SQL, "op10_chat_rotation": OP10_SQL}
