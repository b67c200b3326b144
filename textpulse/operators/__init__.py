"""DataFrame -> DataFrame steps; column names are parameters throughout."""
