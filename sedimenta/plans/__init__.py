"""The platform's tables and the queries on them, put together from the operators."""
