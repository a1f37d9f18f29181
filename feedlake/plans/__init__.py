"""Plans: compositions of operators into the application's queries and jobs,
plus the registry of proof queries with their DuckDB oracle SQL."""
