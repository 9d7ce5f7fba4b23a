"""Training-data operators: dedup, quality, language, scoring, decontamination, token counts, packing.

Nothing outside this package imports it; ``queries.py`` holds the registered queries.
"""
