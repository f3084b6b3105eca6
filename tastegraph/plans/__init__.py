"""Jobs: the registered queries, the tables they read and their SQL checks."""
