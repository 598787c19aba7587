"""The operators of this subpackage as queries over the given tables, and SQL for those that have it."""

from __future__ import annotations

from topictables.llm import collocations, decontamination, languages, lattice, packing, pivots, ranked, simhash, slack, substrings, toxicity, urlfilter, warc

QUERIES = {
    "op1_lattice_likelihood": lattice.op1_lattice_likelihood,
    "op2_packing": packing.op2_packing,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_embedding_near_dedup": pivots.op4_embedding_near_dedup,
    "op5_url_filter_as_of": urlfilter.op5_url_filter_as_of,
    "op6_simhash_near_dedup": simhash.op6_simhash_near_dedup,
    "op7_spaced_seed_decontamination": decontamination.op7_spaced_seed_decontamination,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_language_mixture": languages.op9_language_mixture,
    "op10_warc_transactions": warc.op10_warc_transactions,
    "op11_ranked_search": ranked.op11_ranked_search,
    "op12_best_fit_packing": slack.op12_best_fit_packing,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

ORACLES: dict[str, str] = {
    "op5_url_filter_as_of": urlfilter.ORACLE,
    "op10_warc_transactions": warc.ORACLE,
    "op11_ranked_search": ranked.ORACLE,
    "op13_phrase_collocations": collocations.ORACLE,
}
