"""Training-data operators: corpus cleaning, deduplication, scoring, packing and search."""
