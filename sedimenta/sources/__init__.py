"""Reading and writing: landing CSV, layer tables, JDBC, generated and derived source tables."""
