"""Operators of a training-data pipeline: filtering, extraction, deduplication, tokenisation and archiving of text at scale."""
