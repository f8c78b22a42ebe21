"""DataFrame operators: deduplication, chunks, splits, manifests, verification."""
