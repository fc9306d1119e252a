"""Training-data operators: mixing, language, tokens, vectors, secrets, quality, duplicates, packing.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` holds the registered
queries that apply them to whole tables.
"""
