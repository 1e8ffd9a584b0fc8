"""Training-data operators: quality, deduplication, tokenisation, formatting, sharding."""
