"""Operators for building language-model training data.

Self-contained: nothing else in the library imports this package, and the
query registry adds its queries only when it can be imported.
"""
