"""Whole flows over the operators, and the registered queries."""
