"""Registered queries, grouped by topic; importing this package registers them."""

from . import dataset, explore, features, io, models, rates, scoring, streaming  # noqa: F401
