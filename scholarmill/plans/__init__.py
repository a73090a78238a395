"""The query catalogue and the SQL it is checked against."""
