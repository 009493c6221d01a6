"""Training-data operators: thirteen corpus operators and their registered queries.

Nothing outside this subpackage imports it; ``queries.py`` holds the registered
queries and ``oracles.py`` their DuckDB SQL.
"""
