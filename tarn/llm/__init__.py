"""Training-data operators: clean, deduplicate, classify, mix, format and pack text.

Nothing else in the library imports this subpackage. Each module holds one
operator, ``queries`` registers them over the test tables.
"""
