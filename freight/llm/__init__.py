"""Operators for preparing training data: language, toxicity, duplicates, scoring, mixing, tokens.

The rest of the library works without this folder.
"""
