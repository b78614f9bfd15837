"""Reading raw tables and control files, publishing typed tables."""
