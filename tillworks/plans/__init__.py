"""Jobs that chain operators and write layers."""
