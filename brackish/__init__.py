"""Brackish: lazy DataFrame operators for environmental and time-series data."""
