"""Training-data operators: search, dedup, licences, token counts, mixing, chat, toxicity, HTML, PII, decontamination.

Nothing outside this subpackage (and corpus_pipeline.py) imports it.
"""
