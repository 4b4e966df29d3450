"""Explicit schemas (DDL) of all datasets. Ids are strings everywhere, so nothing is inferred."""

from __future__ import annotations

SAMPLE = (
    "sample_id string, query string, last_query string, category_level1 string, category_level2 string, category_level3 string, domain string,"
    " data string, suggest string, rag string, service string, last_answer_phone string, reference_answers map<string,string>, winner string, _ordinal long"
)
CANDIDATE_FIELDS = "candidate_id: string, model_type: string, model_name: string, response: string, gen_config: string"
GENERATED = f"sample_id string, context string, question string, candidates array<struct<{CANDIDATE_FIELDS}>>"
CHECK = "rule_id: string, hit: boolean, severity: string, score: double, reason: string, excerpt: string"
REPLY = f"checks array<struct<{CHECK}>>, confidence string"
PENALTY = "rule_id: string, score: double, reason: string, excerpt: string"
RESULT_FIELDS = (
    "candidate_id: string, model_type: string, model_name: string, judge: string, ground_score: double, structure_score: double,"
    " aggregate_score: double, total_score_20: double, label: int, weight: double, confidence: double, penalties_json_20: string"
)
JUDGED = f"sample_id string, results array<struct<{RESULT_FIELDS}>>"
MANUAL_FIELDS = "candidate_id: string, model_name: string, model_type: string, aggregate_score: double, ground_score: double, structure_score: double, manual_score: int"
MANUAL = f"sample_id string, source_file string, context string, manual_ranks array<struct<{MANUAL_FIELDS}>>"
