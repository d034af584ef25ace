"""Queries of this subpackage and the SQL that states the same rows."""

from __future__ import annotations

from gazetta.llm.ann import op8_ann
from gazetta.llm.bpe import op6_sentencepiece
from gazetta.llm.centroids import OP12_SQL, op12_centroids
from gazetta.llm.decontaminate import OP2_SQL, op2_decontaminate
from gazetta.llm.htmltext import op3_html
from gazetta.llm.jaccard import OP4_SQL, op4_jaccard
from gazetta.llm.licenses import op7_licenses
from gazetta.llm.linededup import OP5_SQL, op5_line_dedup
from gazetta.llm.neardup import OP11_SQL, op11_near_vectors
from gazetta.llm.negatives import OP13_SQL, op13_hard_negatives
from gazetta.llm.pii import op1_pii
from gazetta.llm.sharding import op9_sharding
from gazetta.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_pii": op1_pii,
    "op2_decontaminate": op2_decontaminate,
    "op3_html": op3_html,
    "op4_jaccard": op4_jaccard,
    "op5_line_dedup": op5_line_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_licenses": op7_licenses,
    "op8_ann": op8_ann,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_near_vectors": op11_near_vectors,
    "op12_centroids": op12_centroids,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {
    "op2_decontaminate": OP2_SQL,
    "op4_jaccard": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op11_near_vectors": OP11_SQL,
    "op12_centroids": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
