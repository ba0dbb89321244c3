"""The six analytical plans, each a chain of DataFrame functions (one per
CTE of the original query), plus their SQL oracles."""
