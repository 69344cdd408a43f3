"""Training-data operators: scans, classifiers, deduplication, search, sharding and tokenisation."""
