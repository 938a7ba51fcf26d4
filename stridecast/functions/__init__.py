"""Column expressions and row-shape changes; nothing here runs a job."""
