"""Training-data operators: search, archives, extraction, tokenising, mixing,
language identification and deduplication. Nothing outside this subpackage
imports it; ``queries.py`` registers its queries."""
