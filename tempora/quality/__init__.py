"""Quality reports: one row per report, built from as few aggregates as possible, then enforced."""
