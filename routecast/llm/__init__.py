"""Training-data operators: tokenising, packing, sharding, joins over text, search.

Each module holds one operator with its own interface. :mod:`.queries` holds
the thin registered queries on the given tables. Nothing outside this
subpackage imports it.
"""
