"""Jobs composed from the operators, and the queries on the test tables."""
