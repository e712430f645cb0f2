"""Sources: fixture views over the driver tables, files (CSV/JSON) and JDBC."""
