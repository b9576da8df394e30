"""Operators for building training corpora (see the README of this folder's
section in the repository README). Nothing else in the library imports this
subpackage; ``queries.py`` holds the registered queries."""
