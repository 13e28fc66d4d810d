"""Importing this package registers all queries of the reference's operators."""

from . import aggregates, assembly, fixtures, gold, joins, matches, merges, models, nested, players, scalars, scores, streams, windows  # noqa: F401
from .catalog import QUERIES, SQL  # noqa: F401
