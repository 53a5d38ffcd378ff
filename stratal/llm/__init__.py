"""Operators of a training-data pipeline: archives, secrets, token files,
near-duplicates, tokenization, languages, licences, vector search, mixing,
toxicity, vector codes, spelling variants.

Nothing outside this folder imports it except ``__spark_entry__`` (guarded)
and ``corpus_pipeline``.
"""
