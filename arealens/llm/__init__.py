"""Operators for preparing text corpora at scale.

Every operator is self-contained in one module of this package; nothing else
in the library imports it.  ``queries.py`` binds the operators to the test
tables (``opN_*``).
"""
