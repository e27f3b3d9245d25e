"""Operations of a training-data pipeline, one module each.

Nothing outside this subpackage imports it. ``queries`` maps the registered
query names to functions, ``corpus_pipeline.py`` chains five operators.
"""
