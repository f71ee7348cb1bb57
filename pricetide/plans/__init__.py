"""The whole run, and the catalogue of checked queries."""
