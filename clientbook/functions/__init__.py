"""Column-level building blocks: ordered rules, money, percentages and periods."""
