"""Training-data operators: scoring, de-duplication, mixing, tokenizing and search.

One module per operator; ``registry`` binds each to the given tables as a named query.
Nothing outside this package imports it.
"""
