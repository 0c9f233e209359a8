"""Training-data operators: thirteen numbered operators and their registered queries.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
