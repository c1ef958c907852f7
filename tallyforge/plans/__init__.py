"""Named queries over the tables, and the SQL that states the same."""
