"""The operators run on the test tables, each beside the SQL that checks it."""
