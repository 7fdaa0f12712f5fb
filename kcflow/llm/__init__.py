"""Training-data pipeline operators over text corpora.

Every operator takes and returns DataFrames, works on whole texts and all
rows, and tolerates nulls, empty tables and extra columns (each module's
docstring states the result).  Nothing outside this subpackage imports it.
"""
