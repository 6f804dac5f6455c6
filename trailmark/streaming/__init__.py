"""The same steps on arriving data."""
