"""Training-data operators on Spark: packing, language ID, decontamination, joins, scoring.

Nothing outside this subpackage imports it.  Each module holds one operator with a
general interface; :mod:`aerolith.llm.queries` derives the contract columns from them.
"""
