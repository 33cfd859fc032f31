"""Input tables, output files and staged intermediate tables."""
