"""Operators for preparing language-model training data at cluster scale.

One module per operator; ``queries`` registers one query for each.  Every
operator takes a documents DataFrame with an integer id and a text column and
works on whole texts.  Intermediate tables that are read more than once are
written to the cluster's shared checkpoint folder (``scratch``).
"""
