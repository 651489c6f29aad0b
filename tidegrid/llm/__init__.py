"""Operators for preparing text corpora for model training.

Nothing outside this folder imports it.  ``queries.queries()`` and
``queries.oracle_sql()`` register one query per operator.
"""
