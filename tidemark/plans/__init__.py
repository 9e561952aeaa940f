"""Compositions of operators: the model layers and the assertions on them."""
