"""Operators for training-data corpora (documents, embeddings).

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; its module holds the operator, the thin ``opN_<name>``
query over a data folder, and the query's DuckDB SQL where SQL can say it.
"""
