"""Operations for preparing language-model training data.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; the thin contract queries built on them are in ``queries``.
"""
