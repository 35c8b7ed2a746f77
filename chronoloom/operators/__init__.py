"""Operators over TimeSeriesFrames."""
