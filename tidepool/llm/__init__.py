"""Training-data operators: deduplication, decontamination, scoring, packing, formatting.

Nothing outside this subpackage (and `corpus_pipeline.py`) imports it.
"""
