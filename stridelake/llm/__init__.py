"""Training-data operators: thirteen corpus operators and the modules that register them as queries."""
