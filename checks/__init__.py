"""Registered queries and the independent SQL they are compared with."""
