"""Composite plans and the bindings of operators to the driver's tables."""
