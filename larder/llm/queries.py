"""Registered queries of the text operators.  Most results have no SQL form; ORACLES has those that do."""

from __future__ import annotations

from larder.llm.bpe import op1_bpe
from larder.llm.collocations import OP12_SQL, op12_collocations
from larder.llm.cross_align import op11_alignment
from larder.llm.decontaminate import op10_decontaminate
from larder.llm.exact_search import OP13_SQL, op13_topk
from larder.llm.jaccard import op6_jaccard
from larder.llm.language_id import op4_language_id
from larder.llm.lm_score import op8_lm_score
from larder.llm.quality import OP3_SQL, op3_quality
from larder.llm.secrets import op7_secrets
from larder.llm.suffix_dedup import op2_suffix_dedup
from larder.llm.token_store import op9_token_store
from larder.llm.toxicity import op5_toxicity

QUERIES = {f.__name__: f for f in (op1_bpe, op2_suffix_dedup, op3_quality, op4_language_id, op5_toxicity, op6_jaccard, op7_secrets, op8_lm_score, op9_token_store, op10_decontaminate, op11_alignment, op12_collocations, op13_topk)}
ORACLES: dict[str, str] = {"op3_quality": OP3_SQL, "op12_collocations": OP12_SQL, "op13_topk": OP13_SQL}
