"""Named queries on the test tables, one per operator, with their SQL twins."""

from grainfold.plans import files, groups, models, rows, sequences, series, texts  # noqa: F401
from grainfold.plans.registry import ORACLES, QUERIES  # noqa: F401
