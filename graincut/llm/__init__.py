"""Training-data operators: sharding, quality, search, toxicity, mixing, packing,
token counts, secrets, near-duplicates and language-model scores.

Nothing outside this package imports it.
"""
