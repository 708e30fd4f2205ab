"""Operators for large training-data pipelines over a ``documents`` table.

Nothing outside this folder imports it. Every operator selects the columns it
needs before it adds its own, so extra or clashing input columns are ignored
unless the operator says that it passes them on.
"""
