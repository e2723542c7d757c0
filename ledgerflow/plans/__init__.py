"""Domain jobs composed of the operators."""
