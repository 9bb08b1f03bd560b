"""Plan shapes shared by the operators: ordered scans, chains, quantiles, components."""
