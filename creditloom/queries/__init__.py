"""Registered queries over the driver tables, each with its SQL twin where one exists."""

from creditloom.queries.registry import QUERIES, TWINS, load_all  # noqa: F401
