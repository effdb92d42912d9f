"""Training-data operators: counting, scoring, deduplicating, cleaning and mixing documents.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; :mod:`.queries` holds the thin
registered queries over the provided tables.
"""
