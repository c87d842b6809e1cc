"""Registered queries of the training-data operators and their oracle SQL."""

from textloom.llm.chat_format import OP10_SQL, op10_chat_format
from textloom.llm.decontam import op5_decontaminate
from textloom.llm.html_extract import op6_html_extract
from textloom.llm.importance import OP11_SQL, op11_importance_resampling
from textloom.llm.license_scan import OP8_SQL, op8_license_scan
from textloom.llm.maxent_lm import op9_maxent_lm
from textloom.llm.mixing import op1_mixing
from textloom.llm.phrases import OP12_SQL, op12_phrases
from textloom.llm.quality import op3_quality_rules
from textloom.llm.sharding import OP13_SQL, op13_histogram_sort
from textloom.llm.simhash import op4_simhash_dedup
from textloom.llm.spans import op7_substring_dedup
from textloom.llm.url_filter import OP2_SQL, op2_url_filter

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_url_filter": op2_url_filter,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_html_extract": op6_html_extract,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_maxent_lm": op9_maxent_lm,
    "op10_chat_format": op10_chat_format,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_phrases": op12_phrases,
    "op13_histogram_sort": op13_histogram_sort,
}
ORACLES = {
    "op2_url_filter": OP2_SQL,
    "op8_license_scan": OP8_SQL,
    "op10_chat_format": OP10_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_phrases": OP12_SQL,
    "op13_histogram_sort": OP13_SQL,
}
