"""Training-data operators: text statistics, tokenizers, joins, de-duplication, mixing.

Each module holds one operator with its own interface (``DataFrame`` in,
``DataFrame`` out); ``queries`` registers a thin query for each of them.
Nothing else in the library imports this subpackage.
"""
