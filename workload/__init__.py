"""The registered queries: their inputs on the given tables, the Spark side and the SQL side."""
