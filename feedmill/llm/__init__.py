"""Training-data operators: deduplication, classification, formatting and packing of text corpora."""
