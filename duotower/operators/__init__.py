"""DataFrame operators: profile, label, index, split, sort, buckets, lookup, towers, metrics, retrieval."""
