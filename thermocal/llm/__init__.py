"""Training-data operators: decontamination, near-duplicates, token files, sharding,
secret scans, language identification, mixing, toxicity and line templates.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
