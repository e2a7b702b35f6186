"""Column helpers and the scale-safe building blocks used by the operators."""
