"""Column-level expressions; every one compiles to built-in, code-generated Spark functions."""
