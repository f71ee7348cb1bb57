"""Loads that read each file once."""
