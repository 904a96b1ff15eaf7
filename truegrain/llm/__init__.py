"""Operators for training corpora: mixing, deduplication, language, packing, sharding, toxicity,
personal data, near duplicates, token output and nearest neighbours."""
