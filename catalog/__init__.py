"""Registered queries, each a Spark callable with its SQL oracle where one exists."""
