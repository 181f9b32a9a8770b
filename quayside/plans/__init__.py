"""Marts (whole jobs) and the named queries over the shared test tables."""
