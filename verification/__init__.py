"""Registered queries and the independent SQL they are checked against."""
