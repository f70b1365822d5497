"""Registered queries over the test tables and the SQL that they are held against."""
