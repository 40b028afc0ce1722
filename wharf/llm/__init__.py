"""Training-data operators: one module per operator, plus ``queries`` (the registered queries)."""
