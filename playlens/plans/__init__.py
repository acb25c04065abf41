"""User-level pipelines built from the operators."""
