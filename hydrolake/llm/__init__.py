"""Operators for training-data pipelines over documents, embeddings and benchmarks.

Nothing outside this folder imports it; ``queries.py`` registers its queries.
"""
