"""Whole loads: strategies, project runs and the run log."""
