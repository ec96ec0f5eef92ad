"""Training-data operators: ten corpus operators and their queries.

Nothing outside this subpackage imports it.
"""
