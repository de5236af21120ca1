"""Writers for summary tables, reports and result messages."""
