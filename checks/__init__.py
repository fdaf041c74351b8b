"""The queries run on the test tables, with the SQL each result must equal."""
