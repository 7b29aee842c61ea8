"""End-to-end plans: prepare, train, evaluate."""
