"""Training-data operators: token output, deduplication, quality rules, packing,
search, classification, mixing and chat repair.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` and the
registered queries in :mod:`barloom.llm.queries` are its only entry points.
"""
