"""Training-data operators: one module per operator, queries in ``queries.py``.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` registers
the queries only when it can be imported.
"""
