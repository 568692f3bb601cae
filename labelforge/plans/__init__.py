"""Tag models and jobs composed from the operators, and the query catalogue."""
