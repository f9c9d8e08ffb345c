"""Sources: table scans (files, catalog, JDBC), queries, control-table CSV, rule JSON."""
