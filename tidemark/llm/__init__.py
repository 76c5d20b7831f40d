"""Training-data operators: sharding, URL filters, packing, token counts, quality, near-duplicates, media columns,
toxicity, source mixing and embedding near-duplicates.

Nothing outside this package imports it; ``queries.py`` holds the registered queries and their SQL.
"""
