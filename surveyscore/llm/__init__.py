"""Operators for preparing training text. Nothing else in the library imports this subpackage.

Each operator reads only the columns it is given by name, so other columns of any name do no harm,
and returns its own columns. Result frames are described in each operator's docstring.
"""
