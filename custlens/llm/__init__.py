"""Training-data operators: packing, filtering, deduplication, tokenisation, sharding and search."""
