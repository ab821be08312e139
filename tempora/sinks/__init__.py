"""Writers for tables, reports and models."""
