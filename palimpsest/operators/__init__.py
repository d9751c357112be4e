"""DataFrame operators of the recognition pipeline."""
