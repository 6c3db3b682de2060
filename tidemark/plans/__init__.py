"""Models built from the operators, and the jobs that read and write tables."""
