"""Schemas of the tables that readers, operators and writers exchange."""

from __future__ import annotations

RESPONSE = "key string, source_id string, url string, page int, status int, content_type string, total_pages int, text string"
RAW_RECORD = (
    "record_id string, source_id string, source_name string, source_url string, canonical_url string, listing_url string, title string, raw_text string, clean_text string, "
    "retrieved_at string, published_at string, deadline string, content_hash string, parser_version int, language string, "
    "extra struct<wp_id:bigint,wp_modified:string,wp_categories:array<string>,wp_tags:array<string>,excerpt:string,feed_title:string>"
)
NORMALIZED = RAW_RECORD + ", word_count int"
CANONICAL = NORMALIZED + ", duplicate_group_size int"
ANNOTATION = (
    "seq bigint, record_id string, input_hash string, task string, prompt_version string, status string, validation_status string, review_flags array<string>, teacher_timestamp string, "
    "teacher_raw_response string, parsed_annotation string, label string, needs_human_review boolean, review_status string, reviewed_at string, verified_at string"
)
VERDICT = "seq bigint, record_id string, verifier string, priority int, verifier_label string, verifier_validation string, agreement boolean, verified_at string"
OVERLAY = "record_id string, final_label string, basis string, needs_human_review boolean, to_verify boolean"
EXAMPLE = "record_id string, source_id string, input string, target string, tier string, split string"
LEDGER = "slot string, ts timestamp, ok boolean, tokens bigint"
SOURCE = "pos int, name string, scope array<string>, postings_page string, api_endpoint string"
