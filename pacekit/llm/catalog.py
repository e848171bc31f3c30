"""The training-data queries and their SQL, as the entry module registers them."""

from .queries import ORACLES, QUERIES  # noqa: F401
