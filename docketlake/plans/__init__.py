"""Registered queries: importing the package registers all of them in ``catalogue``."""

from docketlake.plans import catalogue, landed, listings  # noqa: F401
