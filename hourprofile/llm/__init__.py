"""Operators for training-data pipelines over text, web pages and embeddings.

One module per operator; ``queries`` registers the thin query of each. Nothing
else in the library imports this subpackage.
"""
