"""Explicit schemas; nothing is inferred from data."""

LEDGER = "name string, representative string, confidence string, ord int"
ARCS = "arc_id string, name string, slug string, ch_start int, ch_end int, theme string"
FACT = "event_id bigint, user_id bigint, event_type string, value double, k bigint"
RUN_LOG = "run string, unit string, rc int, message string, logged_at timestamp"
CHAPTER_MAP = "id string, name string, slug string, chapters struct<start:string,end:string>, theme string"
