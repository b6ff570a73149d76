"""Operators for preparing training text, and the pipeline built from them.

Nothing outside this folder imports it.  The numbered modules each hold one
operator with a general interface; ``queries`` holds the registered queries.
"""
