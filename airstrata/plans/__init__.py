"""Layer steps composed from the operators."""
