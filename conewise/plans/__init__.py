"""The model graph and report-side jobs."""
