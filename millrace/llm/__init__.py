"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing outside this folder imports it (``corpus_pipeline.py`` counts as part
of it), so it can be removed as a whole.
"""
