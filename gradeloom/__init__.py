"""gradeloom: evaluation, grading and training tables for generated answers, on Spark."""
