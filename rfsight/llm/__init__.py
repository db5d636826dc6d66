"""Training-data operators: filtering, deduplication, sharding, encoding and packing of text corpora."""
