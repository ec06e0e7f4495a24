"""Training-data operators: one module for each operator, on documents(doc_id, text, lang, source, n_chars).

Nothing outside this subpackage imports it; ``queries.py`` holds its registered queries and
``oracle.py`` their DuckDB twins.
"""
