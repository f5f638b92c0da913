"""Column expressions; all of them are Spark built-ins, none is a Python UDF."""
