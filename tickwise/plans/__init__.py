"""Composed jobs and the driver-table query catalog."""
