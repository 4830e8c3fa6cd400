"""End-to-end plans composed from the operators: load, profile and validate."""
