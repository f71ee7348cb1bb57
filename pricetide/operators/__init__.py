"""DataFrame-to-DataFrame steps between the layers."""
