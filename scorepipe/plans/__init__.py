"""Compositions of operators: dataset graph, training sweep, run tracking."""
