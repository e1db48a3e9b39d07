"""Operators for preparing training text: search, deduplication, tokens, pages, chats, rules."""
