"""Queries over whole tables, each with the SQL that says the same where SQL can."""
