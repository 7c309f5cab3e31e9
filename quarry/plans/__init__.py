"""Driver-table fixtures and registered queries."""
