"""Column expressions over panels of daily bars."""
