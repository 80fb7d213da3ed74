"""hailmeter: metered trips joined to hourly weather, as plain Spark jobs."""
