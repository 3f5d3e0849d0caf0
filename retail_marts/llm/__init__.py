"""Training-data operators: ten corpus operators and the pipeline built of them.

Nothing else in the library imports this subpackage. Each operator module has
a general operator and the thin ``opN_<name>`` query that applies it to its
whole table; ``catalog.py`` lists the queries and their SQL.
"""
