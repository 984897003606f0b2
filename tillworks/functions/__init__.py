"""Column expressions shared by the operators; all are Catalyst built-ins."""
