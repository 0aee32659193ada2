"""Compositions of operators: clean, explore, train, monitor, what-if."""
