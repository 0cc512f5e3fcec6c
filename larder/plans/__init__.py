"""Whole jobs built from the operators, one function per stage."""
