"""Training-data operators: URL filters, language id, decontamination, near and
exact dedup, token counts, source mixing, WARC archives, quality labels."""
