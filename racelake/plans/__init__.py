"""Whole table jobs built from the operators: session plan, bronze, silver, gold."""
