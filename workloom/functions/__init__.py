"""functions of the job-market engine."""
