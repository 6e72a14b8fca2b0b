"""Training-data operators: text formatting, scanning, fingerprints and
near-duplicate joins for large corpora.

Nothing outside this package imports it; its queries are registered by
``__spark_entry__`` from :mod:`starmart.llm.queries`.
"""
