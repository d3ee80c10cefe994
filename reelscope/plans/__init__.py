"""Plans: fixture views over the driver tables, registered queries, jobs."""
