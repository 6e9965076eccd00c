"""Column expressions: row-wise features, quantiles and name handling."""
