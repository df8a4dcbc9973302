"""Column-level functions: decoding, encoding and scalar transformations."""
