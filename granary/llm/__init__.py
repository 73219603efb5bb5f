"""Training-data operators: one module for each, with the query that binds it to the tables in ``queries``."""
