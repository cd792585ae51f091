"""Training-data operators: fingerprints, chat examples, packing, mixing, tokens, near-duplicates, licenses, language."""
