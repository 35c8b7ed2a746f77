"""The same time-series steps on unbounded input."""
