"""Operators of a training-data pipeline.

One module per operator; `queries.py` binds them to the test tables and
`oracles.py` holds the DuckDB twins.  Nothing outside this folder and
`corpus_pipeline.py` imports it.
"""
