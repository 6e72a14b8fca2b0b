"""Queries that SQL can't express, and the tests that check them instead."""

BRUTE_FORCE = {
    "op2_license_scan": "llm/test_llm_operators.py::test_licenses",
    "op3_html_extract": "llm/test_llm_operators.py::test_html",
    "op4_secret_scan": "llm/test_llm_operators.py::test_secrets",
    "op6_document_fingerprints": "llm/test_llm_operators.py::test_fingerprints",
    "op8_sentencepiece": "llm/test_llm_operators.py::test_sentence_pieces_equal_the_library",
    "op9_quality_classifier": "llm/test_llm_operators.py::test_kneser_ney",
    "op11_token_alignment": "llm/test_token_alignment.py::test_digests_equal_brute_force",
    "pipeline": "llm/test_llm_operators.py::test_pipeline",
}
