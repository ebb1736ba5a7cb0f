"""Operators for training-data pipelines: near and exact duplicates, quality,
language-model scores, mixing, packing, vector search and dated URL lists."""
