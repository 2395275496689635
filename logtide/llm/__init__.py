"""Operators of a training-data pipeline: filtering, near-duplicates, tokens, archives, packing.

Nothing else in the library imports this subpackage. Every operator is a
function from DataFrames to a DataFrame; `queries` applies each of them to its
whole table. Common rules:

* only the named id and text columns are read, so extra columns, whatever
  their names, never clash;
* a null text counts as the empty text, repeated rows are rows like any other,
  and an empty table gives an empty result with the same columns.
"""
