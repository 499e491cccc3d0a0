"""Training-data operators: language id, tokenising, quality, chat, near-dedup,
URL rules, WARC bundles, personal data, fingerprints and decontamination.

Nothing outside this subpackage imports it.
"""
