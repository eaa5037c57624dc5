"""Training-data operators: deduplication, quality, mixing, sharding, packing, chat and URL rules.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` depends on it.
"""
