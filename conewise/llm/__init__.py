"""Training-data operators on Spark: filters, de-duplication, tokens, packing, PII.

Nothing else in the library imports this subpackage.
"""
