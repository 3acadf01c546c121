"""The numbered queries and their SQL."""

from __future__ import annotations

from riskweave.llm.collocations import OP13_SQL, op13_collocations
from riskweave.llm.dedup import OP3_SQL, op3_exact_dedup
from riskweave.llm.lm import op8_lattice_lm
from riskweave.llm.mixing import OP2_SQL, op2_mix_sources
from riskweave.llm.notices import op11_notices
from riskweave.llm.packing import op10_pack_mixture
from riskweave.llm.passages import OP9_SQL, op9_remove_repeats
from riskweave.llm.sharding import op1_shard_minimax
from riskweave.llm.simhash import op5_simhash_components
from riskweave.llm.tokens import op7_count_tokens
from riskweave.llm.topk import OP4_SQL, op4_top_k
from riskweave.llm.toxicity import op6_toxicity
from riskweave.llm.whitening import op12_whiten

QUERIES = {
    "op1_shard_minimax": op1_shard_minimax,
    "op2_mix_sources": op2_mix_sources,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_top_k": op4_top_k,
    "op5_simhash_components": op5_simhash_components,
    "op6_toxicity": op6_toxicity,
    "op7_count_tokens": op7_count_tokens,
    "op8_lattice_lm": op8_lattice_lm,
    "op9_remove_repeats": op9_remove_repeats,
    "op10_pack_mixture": op10_pack_mixture,
    "op11_notices": op11_notices,
    "op12_whiten": op12_whiten,
    "op13_collocations": op13_collocations,
}
SQL = {
    "op2_mix_sources": OP2_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op4_top_k": OP4_SQL,
    "op9_remove_repeats": OP9_SQL,
    "op11_notices": op11_notices,
    "op12_whiten": op12_whiten,
    "op13_collocations": OP13_SQL,
}
