"""Writers for result tables and the run log."""
