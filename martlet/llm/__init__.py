"""Training-data operators: tokenising, extraction, dedup, scans, packing.

Nothing outside this subpackage imports it; ``queries.py`` registers one
query per operator and ``corpus_pipeline.py`` (repository top) chains five."""
