"""Training-data operators and their registered queries.

Nothing outside this subpackage imports it.
"""
