"""Operators of a training-data pipeline: dedup, classifiers, tokenizers,
mixing, sharding, archives and vector search.  Nothing else in the library
imports this subpackage."""
