"""Operators of a training-data pipeline: deduplication, secret scans,
language identification, archives, tokenizers and decontamination.

Nothing else in the library imports this subpackage; its queries are in
``precinct.llm.queries``.
"""
