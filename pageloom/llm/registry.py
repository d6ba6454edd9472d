"""Queries of this package and their SQL."""

from pageloom.llm.chat import OP7_SQL, op7_prefix_targets
from pageloom.llm.jaccard import OP3_SQL, op3_jaccard_join
from pageloom.llm.language import op2_language
from pageloom.llm.mixing import op9_mix_sources
from pageloom.llm.near_vectors import OP10_SQL, op10_near_vectors
from pageloom.llm.packing import op4_pack_mixture
from pageloom.llm.permutation import op6_permutation_search
from pageloom.llm.rans import op5_rans_files
from pageloom.llm.toxicity import op8_toxicity
from pageloom.llm.warc import OP1_SQL, op1_resolve_revisits

QUERIES = {
    "op1_resolve_revisits": op1_resolve_revisits,
    "op2_language": op2_language,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_pack_mixture": op4_pack_mixture,
    "op5_rans_files": op5_rans_files,
    "op6_permutation_search": op6_permutation_search,
    "op7_prefix_targets": op7_prefix_targets,
    "op8_toxicity": op8_toxicity,
    "op9_mix_sources": op9_mix_sources,
    "op10_near_vectors": op10_near_vectors,
}
SQL = {"op1_resolve_revisits": OP1_SQL, "op3_jaccard_join": OP3_SQL, "op7_prefix_targets": OP7_SQL, "op10_near_vectors": OP10_SQL}
