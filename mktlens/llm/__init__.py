"""Training-data operators: extraction, language, quality, deduplication,
mixing, packing and archives.

Nothing else in the library imports this package.  ``queries`` registers one
``opN_`` query per operator; ``corpus_pipeline.py`` at the repository top
chains five of them.
"""
