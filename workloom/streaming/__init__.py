"""streaming of the job-market engine."""
