"""Training-data operators: quality, language, deduplication, tokens, URLs, decontamination.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only where it is present.
"""
