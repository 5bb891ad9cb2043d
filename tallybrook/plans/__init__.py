"""The registered queries, each with the SQL it is checked against."""
