"""Column expressions shared by the operators; all of them are Spark built-ins."""
