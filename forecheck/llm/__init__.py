"""Training-data operators: quality, decontamination, deduplication, formatting,
tokenization, licences, toxicity, archives and URL rules.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
only when it is present.
"""
