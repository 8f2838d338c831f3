"""Job options, whole jobs, and the registry of checked queries."""
