"""operators of the job-market engine."""
