"""Operators that a training-data pipeline needs: token counts, language-model
scores, personal data, near and exact duplicates, quality rules, packing, web
archives, source mixing and URL filters.  Nothing outside this folder imports it."""
