"""Queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from tripkit.llm import (alignment, best_fit, chat_format, ctph, decision_list, fair_mix, language_id, ngram_score, orc_tokens, simhash, substrings,
                         warc, whitening)

QUERIES = {
    "op1_ngram_trie": ngram_score.op1_ngram_trie,
    "op2_ctph": ctph.op2_ctph,
    "op3_warc_index": warc.op3_warc_index,
    "op4_fair_mix": fair_mix.op4_fair_mix,
    "op5_orc_tokens": orc_tokens.op5_orc_tokens,
    "op6_simhash": simhash.op6_simhash,
    "op7_count_min": substrings.op7_count_min,
    "op8_decision_list": decision_list.op8_decision_list,
    "op9_chat_format": chat_format.op9_chat_format,
    "op10_best_fit": best_fit.op10_best_fit,
    "op11_alignment": alignment.op11_alignment,
    "op12_whitening": whitening.op12_whitening,
    "op13_language_id": language_id.op13_language_id,
}
ORACLE: dict[str, str] = {
    "op3_warc_index": warc.OP3_SQL,
    "op4_fair_mix": fair_mix.OP4_SQL,
    "op7_count_min": substrings.OP7_SQL,
    "op9_chat_format": chat_format.OP9_SQL,
}
