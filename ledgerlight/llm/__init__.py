"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

Each module holds one operator with its own general interface; the thin
``opN_`` queries built on them are in :mod:`ledgerlight.llm.queries`.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
