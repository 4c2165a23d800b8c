"""Operators for preparing training text: filters, deduplication, tokens, packing, chat.

Nothing else in the library imports this subpackage. ``tidemark.llm.queries``
holds its registered queries and their SQL.
"""
