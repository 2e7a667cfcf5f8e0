"""Operators for large-scale training-data pipelines.

One module per operator; ``queries`` registers one ``opN_<name>`` query each.
Nothing outside this subpackage imports it.
"""
