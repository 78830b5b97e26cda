"""Registered queries, the views they read, and the SQL each is checked against."""
