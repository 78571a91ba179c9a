"""Operators of a training-data pipeline over the ``documents`` table.

One module per operator; ``queries`` holds the registered ``opN_*`` queries and
``corpus_pipeline`` (repository top) chains five of them. Nothing else in the
library imports this package.
"""
