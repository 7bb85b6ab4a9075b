"""Column expressions: numeric, date, binning, array and text functions."""
