"""Training-data operators: packing, deduplication, sketches, sharding, tokens, quality, PII, licences.

Nothing outside this package imports it.  Every operator is a plain
``DataFrame -> DataFrame`` function; ``queries.py`` registers one query per
operator.
"""
