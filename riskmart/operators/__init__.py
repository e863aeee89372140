"""DataFrame-to-DataFrame jobs, one module per layer."""
