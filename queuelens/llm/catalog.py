"""Registry of the subpackage: query name -> function, and DuckDB SQL where it exists."""

from __future__ import annotations

from queuelens.llm.bpe import op3_byte_bpe
from queuelens.llm.chat import op4_chat_format
from queuelens.llm.collocations import OP11_SQL, op11_collocations
from queuelens.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from queuelens.llm.langid import op7_language_id
from queuelens.llm.lexical import OP13_SQL, op13_lexical_search
from queuelens.llm.minhash import OP12_SQL, op12_minhash
from queuelens.llm.packing import op5_packing
from queuelens.llm.secrets import op1_secret_scan
from queuelens.llm.simhash import op10_simhash
from queuelens.llm.substrings import op2_substring_dedup
from queuelens.llm.topk import OP6_SQL, op6_top_k
from queuelens.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_chat_format": op4_chat_format,
    "op5_packing": op5_packing,
    "op6_top_k": op6_top_k,
    "op7_language_id": op7_language_id,
    "op8_toxicity": op8_toxicity,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_simhash": op10_simhash,
    "op11_collocations": op11_collocations,
    "op12_minhash": op12_minhash,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES = {
    "op6_top_k": OP6_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_collocations": OP11_SQL,
    "op12_minhash": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
