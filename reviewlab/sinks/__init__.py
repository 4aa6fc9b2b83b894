"""Writers of stage tables and reports."""
