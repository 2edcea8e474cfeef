"""Training-data operators: dedup, extraction, filtering, mixing, formatting and archiving of text corpora."""
