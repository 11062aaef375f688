"""Operators for preparing training text: archives, near copies, repeated passages, benchmark
passages, quality, tokens, language models, main text of pages and preference pairs."""
