"""DataFrame to DataFrame operators, for tables and streams alike."""
