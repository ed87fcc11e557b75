"""Dataset-level flows and the driver's queries."""
