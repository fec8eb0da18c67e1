"""Where results go: catalog tables and JDBC metric tables."""
