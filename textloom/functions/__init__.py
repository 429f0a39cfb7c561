"""Column expressions: each takes and returns `Column`, nothing here runs a job."""
