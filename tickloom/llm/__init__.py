"""Operators of a training-data pipeline on Spark; nothing else in the library imports them.

Rules that hold for every operator here: texts are taken whole; a null text is an empty text unless
the operator says otherwise; rows that repeat are treated each on its own; further columns of the
input are ignored by the numbered queries and never clash with working columns, because an operator
first selects the columns it was told to use; an empty table gives an empty result.
"""
