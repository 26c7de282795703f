"""Column expressions: no function here runs a job."""
