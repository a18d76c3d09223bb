"""Holdfast: tabular prediction work on Spark DataFrames.

Every operator takes and returns DataFrames.  Import from the subpackages:
``sources``, ``functions``, ``operators``, ``plans`` and ``streaming``.
"""
