"""Query plans: stand-in views, reference flows and the registered queries.

``catalog.queries()`` / ``catalog.oracle_sql()`` back ``__spark_entry__``.
"""
