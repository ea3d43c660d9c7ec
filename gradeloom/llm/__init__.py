"""Operators of a training-data pipeline: quality, chat, scoring, near copies, licenses, toxicity, token files and URLs."""
