"""Derived board tables and the registered queries over them."""
