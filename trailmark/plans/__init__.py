"""End-to-end runs."""
