"""Operators for preparing language-model training data.

One module per operator; :mod:`adcube.llm.queries` registers them.  Nothing in
the rest of the library imports this subpackage.
"""
