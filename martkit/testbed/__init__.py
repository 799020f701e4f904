"""Raw tables derived from the driver's test tables, the registered queries, and their oracle SQL."""
