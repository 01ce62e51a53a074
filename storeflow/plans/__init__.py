"""Plan building blocks: skew handling, lineage cuts, reports, table views."""
