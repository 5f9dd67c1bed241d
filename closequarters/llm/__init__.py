"""Training-data operators: exact, near and line deduplication, quality and
toxicity models, licence scans, chat formatting, tokenising and packing.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; ``queries.py`` registers one thin query per operator.
"""
