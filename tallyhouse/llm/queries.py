"""The queries of this folder and the SQL they are checked against."""

from tallyhouse.llm import (
    bpe, chat, classifier, fixity, hard_negatives, jaccard_join, license_scan, near_vectors, packing, quality_rules, spelling, suffix_dedup,
    topk_search,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_merkle_fixity": fixity.op2_merkle_fixity,
    "op3_chat_formatting": chat.op3_chat_formatting,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_quality_classifier": classifier.op5_quality_classifier,
    "op6_near_vectors": near_vectors.op6_near_vectors,
    "op7_bpe": bpe.op7_bpe,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_packing": packing.op9_packing,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_topk_search": topk_search.op11_topk_search,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}
ORACLE = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_merkle_fixity": fixity.ORACLE,
    "op6_near_vectors": near_vectors.ORACLE,
    "op3_chat_formatting": chat.ORACLE,
    "op10_license_scan": license_scan.ORACLE,
    "op11_topk_search": topk_search.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_spelling_variants": spelling.ORACLE,
}
