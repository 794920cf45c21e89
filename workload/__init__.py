"""Queries of every operator on the provided tables, and the SQL each is checked against."""
