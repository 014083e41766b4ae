"""DataFrame-in, DataFrame-out operators. Nothing here runs a job."""
