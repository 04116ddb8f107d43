"""Training-data operators (scoring, dedup, search, tokenising, packing, classification).

Self-contained: nothing outside this subpackage imports it.
"""
