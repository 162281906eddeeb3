"""Operators for training-data pipelines over tables of documents, pages and labels.

Nothing else in the library imports this package.
"""
