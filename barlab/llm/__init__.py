"""Training-data operators: dedup, decontamination, classifiers, mixing, packing.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames, selects the columns it needs by name (extra columns of the
caller never clash) and states in its docstring what nulls, empty texts, ties,
repeated rows and empty tables give.
"""
