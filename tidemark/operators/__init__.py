"""DataFrame to DataFrame operators: decode, fold, merge, checks, layout, metrics."""
