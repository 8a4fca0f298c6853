"""The unknown member of every dimension."""

UNKNOWN_KEY = -1
UNKNOWN_TEXT = "(desconhecido)"
