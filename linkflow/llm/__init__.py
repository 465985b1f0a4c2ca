"""Operators for preparing training text at scale.

Each module holds one operator; ``queries`` registers them.  Nothing else in
the library imports this subpackage.
"""
