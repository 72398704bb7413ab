"""Plan helpers shared by the operators, and the end-to-end jobs."""
