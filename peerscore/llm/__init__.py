"""Training-data operators: language, toxicity, tokens, licences, near duplicates, search and packing.

Nothing outside this package imports it; the registered queries are in :mod:`peerscore.llm.queries`.
"""
