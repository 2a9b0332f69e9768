"""Developer-activity analytics over code-hosting event archives, built on Spark."""
