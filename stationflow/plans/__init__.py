"""Station views over the shared test tables, registered queries and their SQL."""
