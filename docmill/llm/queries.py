"""Registered queries of this package, and their SQL."""

from __future__ import annotations

from docmill.llm.bpe import op8_word_bpe
from docmill.llm.filter_audit import OP11_SQL, op11_filter_audit
from docmill.llm.licenses import OP12_SQL, op12_license_scan
from docmill.llm.line_dedup import OP7_SQL, op7_line_dedup
from docmill.llm.mixing import OP5_SQL, op5_poisson_mix
from docmill.llm.pseudonyms import op10_feistel_pseudonyms
from docmill.llm.quality import op1_quality_rules
from docmill.llm.resampling import op13_importance_resampling
from docmill.llm.set_join import op4_chosen_path_join
from docmill.llm.token_files import op3_rans_token_files
from docmill.llm.top_k import OP6_SQL, op6_exact_top_k
from docmill.llm.toxicity import op2_weak_toxicity
from docmill.llm.url_filter import OP9_SQL, op9_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_weak_toxicity,
        op3_rans_token_files,
        op4_chosen_path_join,
        op5_poisson_mix,
        op6_exact_top_k,
        op7_line_dedup,
        op8_word_bpe,
        op9_url_filter,
        op10_feistel_pseudonyms,
        op11_filter_audit,
        op12_license_scan,
        op13_importance_resampling,
    )
}
SQL = {
    "op5_poisson_mix": OP5_SQL,
    "op6_exact_top_k": OP6_SQL,
    "op7_line_dedup": OP7_SQL,
    "op9_url_filter": OP9_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_license_scan": OP12_SQL,
}
