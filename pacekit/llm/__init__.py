"""Training-data operators: scans, deduplication, scoring, mixing, sharding and packing of documents."""
