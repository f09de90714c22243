"""Column expressions. All run inside whole-stage codegen; none is a Python UDF."""
