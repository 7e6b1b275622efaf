"""Training-data operators: media, near duplicates, classifiers, language model, packing, mixing.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
