"""Operators for preparing training text. Nothing else in the library imports this subpackage.

Every operator is a function from DataFrames to DataFrames with its own general parameters; the
``opN_<name>`` queries in ``queries.py`` apply them to whole tables. General rules of all of them:

* a NULL text counts as the empty text, a NULL id is an id like any other and is handed through;
* only the named columns are read, so further columns, whatever their names, cannot clash;
* an empty table gives an empty result with the same columns;
* repeated rows are rows of their own unless an operator says otherwise.
"""
