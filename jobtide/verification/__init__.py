"""Postings derived from the test tables, and the SQL the results must equal."""
