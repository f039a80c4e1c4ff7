"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from skymetrics.llm.cost_packing import op13_cost_packing
from skymetrics.llm.language_id import op5_language_id
from skymetrics.llm.license_scan import op3_license_scan
from skymetrics.llm.mixing import op1_mixing
from skymetrics.llm.oracle import ORACLE
from skymetrics.llm.packing import op2_best_fit_packing
from skymetrics.llm.phrase_mining import op12_phrase_mining
from skymetrics.llm.pitman_yor_lm import op9_pitman_yor_lm
from skymetrics.llm.quality_classifier import op7_quality_classifier
from skymetrics.llm.quality_rules import op8_quality_rules
from skymetrics.llm.ranked_search import op11_ranked_search
from skymetrics.llm.simhash_dedup import op10_simhash_dedup
from skymetrics.llm.token_files import op4_token_files
from skymetrics.llm.topk_search import op6_topk_search

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    query.__name__: query
    for query in (
        op1_mixing,
        op2_best_fit_packing,
        op3_license_scan,
        op4_token_files,
        op5_language_id,
        op6_topk_search,
        op7_quality_classifier,
        op8_quality_rules,
        op9_pitman_yor_lm,
        op10_simhash_dedup,
        op11_ranked_search,
        op12_phrase_mining,
        op13_cost_packing,
    )
}
