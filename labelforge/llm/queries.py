"""Registered queries of the subpackage and, where SQL can state them, their oracle."""

from __future__ import annotations

from labelforge.llm import chat, collocations, decontam, neighbours, packing, phrases, pii, secrets, shards, simhash, \
    toxicity, variants, warc

QUERIES = {
    "op1_tool_call_linking": chat.query,
    "op2_best_fit_swap_packing": packing.query,
    "op3_balanced_posting_lists": neighbours.query,
    "op4_noisy_channel_toxicity": toxicity.query,
    "op5_repeated_phrase_automata": phrases.query,
    "op6_suffix_array_decontamination": decontam.query,
    "op7_two_pass_shuffle_shards": shards.query,
    "op8_warc_revisit_resolution": warc.query,
    "op9_forest_secret_scan": secrets.query,
    "op10_simhash_ball_components": simhash.query,
    "op11_gram_spelling_variants": variants.query,
    "op12_boosted_personal_data": pii.query,
    "op13_fingerprint_collocations": collocations.query,
}

ORACLE: dict[str, str] = {
    "op5_repeated_phrase_automata": phrases.ORACLE,
    "op6_suffix_array_decontamination": decontam.ORACLE,
    "op8_warc_revisit_resolution": warc.ORACLE,
    "op13_fingerprint_collocations": collocations.ORACLE,
}
