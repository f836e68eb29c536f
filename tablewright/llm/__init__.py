"""Training-data operators: near-duplicate joins, chat formatting, line dedup, quality
classification and rules, mixing, HTML extraction, language id, packing, fingerprints."""
