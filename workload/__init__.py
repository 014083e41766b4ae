"""The registered queries: change feeds over the given tables, the queries and their SQL twins."""
