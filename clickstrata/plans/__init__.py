"""Ready-made reports composed from the operators, one module per log family."""
