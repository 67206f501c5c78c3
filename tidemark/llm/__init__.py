"""Training-data operators: dedup, mixing, quality, privacy, tokenizing, search, scoring."""
