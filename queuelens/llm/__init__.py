"""Training-data operators: dedup, secrets, tokenizing, packing, search, classifiers."""
