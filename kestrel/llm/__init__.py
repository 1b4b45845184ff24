"""Training-data operators: mixing, tokenising, scrubbing, scoring and de-duplicating text corpora.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
