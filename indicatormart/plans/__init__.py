"""Model graph: staging -> reference (dimensions, facts) -> marts."""
