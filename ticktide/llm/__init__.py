"""Training-data operators: each module holds one operator and its general interface.

Nothing outside this subpackage imports it. ``queries.py`` has the thin registered
queries, ``oracles.py`` the SQL that checks those SQL can express.
"""
