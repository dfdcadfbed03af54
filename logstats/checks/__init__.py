"""The operators as queries over sample tables, each with the SQL to compare with."""
