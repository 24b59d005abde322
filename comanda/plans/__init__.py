"""End-to-end plans composed of operators, and the registry of named queries."""
