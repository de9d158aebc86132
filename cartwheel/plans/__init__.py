"""Plan-level building blocks: the star mapping, skew handling, registered queries."""
