"""Operators for preparing training text at scale.

Each module has one operator with its own general interface plus the thin
registered query ``opN_<name>``; ``queries.py`` lists them.  Nothing outside
this subpackage (and ``corpus_pipeline.py``) imports it.
"""
