"""Operators for building training corpora: exact and near deduplication,
quality scoring, decontamination, archives, tokenised output and packing.

Nothing else in the library imports this subpackage; its queries are collected
in :mod:`plantwise.llm.queries`.
"""
