"""The registered queries of the dealt operators and their DuckDB SQL."""

from __future__ import annotations

from medallion.llm.bpe import op8_bpe
from medallion.llm.decontaminate import op9_decontamination
from medallion.llm.jaccard import op1_ngram_jaccard, op1_ngram_jaccard_links
from medallion.llm.languages import op7_language_id
from medallion.llm.periodic_runs import op12_periodic_runs
from medallion.llm.quality import op6_quality
from medallion.llm.secrets import op2_secret_ledger, op2_secret_scan
from medallion.llm.substrings import op10_substring_dedup
from medallion.llm.suffixes import op3_suffix_array_dedup
from medallion.llm.token_counts import op4_token_counts
from medallion.llm.topk import op5_topk
from medallion.llm.url_filters import op11_url_filters
from medallion.llm.whitening import op13_whitening

QUERIES = {f.__name__: f for f in (op1_ngram_jaccard, op2_secret_scan, op3_suffix_array_dedup, op4_token_counts, op5_topk, op6_quality, op7_language_id, op8_bpe, op9_decontamination, op10_substring_dedup, op11_url_filters, op12_periodic_runs, op13_whitening, op1_ngram_jaccard_links, op2_secret_ledger)}


def queries() -> dict:
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    from medallion.llm.oracles import SQL

    return dict(SQL)
