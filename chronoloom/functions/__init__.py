"""Column-level building blocks: time steps, ordered windows, quantiles, metrics."""
