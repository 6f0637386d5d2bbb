"""Column expressions shared by the operators and the answers."""
