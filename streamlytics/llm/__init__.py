"""Operators for training-data pipelines: filtering, deduplication, decontamination,
token accounting, language-model scoring, quality and toxicity models, packing.

Every operator takes a DataFrame with the columns it names (``doc_id``, ``text``, ...)
and ignores all others, so extra or clashing columns never matter. ``queries`` holds
the registered ``opN_<name>`` queries and their SQL.
"""
