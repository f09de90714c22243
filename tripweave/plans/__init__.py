"""End-to-end runs, the registered queries and their reference SQL."""
