"""Report specifications and the jobs that run them."""
