"""Operators for preparing training data at scale. Nothing else in the
library imports this subpackage.

Shared rules, which each operator's docstring completes: a null text counts
as empty; every input row, repeated ones too, yields its own result; an empty
table yields an empty result of the same columns; columns an operator does
not name are ignored, whatever they are called.
"""
