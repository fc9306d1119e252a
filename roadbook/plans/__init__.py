"""Plans: fixture projections of the driver tables and stage compositions."""
