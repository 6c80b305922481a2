"""Runnable queries over the sample tables, each with the SQL that must agree with it."""
