"""End-to-end batch plans built from the operators."""
