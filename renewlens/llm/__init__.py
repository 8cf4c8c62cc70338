"""Operators for a training-data pipeline over documents, pages, vectors and conversations.

Nothing else in the library imports this subpackage.  ``queries.py`` registers one query
per operator; ``corpus_pipeline.py`` at the top of the repository chains five of them.
"""
