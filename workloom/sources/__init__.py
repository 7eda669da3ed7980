"""sources of the job-market engine."""
