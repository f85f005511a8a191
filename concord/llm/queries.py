"""Queries of the numbered operators, each over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from concord.llm import rule_ledger, url_trie, warc_revisit
from concord.llm.bpe import op5_numpy_bpe
from concord.llm.importance_draw import op13_crc_ring_resampling
from concord.llm.media_chunks import op6_gear_chunks
from concord.llm.minmax_dedup import op11_minmax_hashing
from concord.llm.packing import op4_cost_balanced_packing
from concord.llm.quality_classifier import op2_co_training
from concord.llm.rule_ledger import op8_rule_ledger
from concord.llm.secret_links import op9_credential_linking
from concord.llm.sharding import op1_minimax_sharding
from concord.llm.simhash_dedup import op3_simhash_trie
from concord.llm.tandem_runs import op12_gusfield_stoye_runs
from concord.llm.url_trie import op7_url_trie
from concord.llm.warc_revisit import op10_warc_revisits

QUERIES = {
    "op1_minimax_sharding": op1_minimax_sharding,
    "op2_co_training": op2_co_training,
    "op3_simhash_trie": op3_simhash_trie,
    "op4_cost_balanced_packing": op4_cost_balanced_packing,
    "op5_numpy_bpe": op5_numpy_bpe,
    "op6_gear_chunks": op6_gear_chunks,
    "op7_url_trie": op7_url_trie,
    "op8_rule_ledger": op8_rule_ledger,
    "op9_credential_linking": op9_credential_linking,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_minmax_hashing": op11_minmax_hashing,
    "op12_gusfield_stoye_runs": op12_gusfield_stoye_runs,
    "op13_crc_ring_resampling": op13_crc_ring_resampling,
    "rule_ablations": rule_ledger.rule_ablations,
}

ORACLE_SQL: dict[str, str] = {
    "op7_url_trie": url_trie.ORACLE,
    "op8_rule_ledger": rule_ledger.ORACLE,
    "op11_minmax_hashing": op11_minmax_hashing,
    "op12_gusfield_stoye_runs": op12_gusfield_stoye_runs,
    "op13_crc_ring_resampling": op13_crc_ring_resampling,
    "rule_ablations": rule_ledger.ABLATIONS_ORACLE,
    "op10_warc_revisits": warc_revisit.ORACLE,
}
