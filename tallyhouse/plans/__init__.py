"""Whole jobs made of operators: building the warehouse, and the list of ready queries."""
