"""Registered queries over the sample tables, with the SQL that must agree with them."""
