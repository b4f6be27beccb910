"""The concrete tables built from the operators, and a whole run."""
