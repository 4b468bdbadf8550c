"""Training-data operators: dedup, mixing, search, classification, encoding.

Every operator takes and returns DataFrames. Nothing else in the library
imports this package; ``llm.queries`` registers one query per operator.
"""
