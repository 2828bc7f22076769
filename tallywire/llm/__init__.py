"""Training-data operators: token output, sharding, counting, deduplication, packing and quality rules."""
