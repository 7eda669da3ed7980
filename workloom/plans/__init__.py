"""plans of the job-market engine."""
