"""Column expressions: KPI measures, labels, time bins, rounding."""
