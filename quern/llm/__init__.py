"""Training-data operators: token counts, decontamination, secrets, extraction, mixing, dedup, quality, WARC, licenses.

Nothing outside this subpackage imports it. ``queries`` and ``oracles`` live in ``registry``.
"""
