"""Operators for large text corpora; nothing else in the library imports them.

Each operator is a module; `catalog` holds the registered queries and their SQL.
"""
