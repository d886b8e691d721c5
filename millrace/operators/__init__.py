"""Row checks, integration, reject logs and run metrics."""
