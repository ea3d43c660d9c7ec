"""Column-level functions: every one maps Column arguments to a Column."""
