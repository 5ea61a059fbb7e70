"""Query plans over the test tables: ``queries()`` and ``oracle_sql()`` of each module make the registry."""
