"""Queries of the training-data operators. SQL expresses none of them whole; tests/llm compares with brute force."""

from creamline.llm.embedding_dedup import op9_embedding_near_dedup
from creamline.llm.importance import op12_importance_resampling
from creamline.llm.licenses import op5_license_scan
from creamline.llm.mixing import op4_source_mixing
from creamline.llm.page_text import op13_html_extraction
from creamline.llm.pii import op8_personal_data
from creamline.llm.pieces import op7_sentencepiece
from creamline.llm.quality_model import op2_quality_classifier
from creamline.llm.quality_rules import op6_quality_rules
from creamline.llm.simhash import op1_simhash_near_dedup
from creamline.llm.suffix_dedup import op3_suffix_array_dedup
from creamline.llm.token_counts import op10_token_counts
from creamline.llm.turn_repair import op11_conversation_repair

QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_source_mixing": op4_source_mixing,
    "op5_license_scan": op5_license_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_personal_data": op8_personal_data,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_html_extraction": op13_html_extraction,
}
SQL: dict[str, str] = {}
