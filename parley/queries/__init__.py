"""The operators bound to the test tables, and the SQL to check them with."""
