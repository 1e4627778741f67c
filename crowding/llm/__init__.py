"""Training-data operators: tokens, quality, language, duplicates, packing, search.

Each module holds one operator with a general interface; ``queries`` has the
registered queries and ``oracle`` their DuckDB SQL. Nothing outside this
subpackage imports it.
"""
