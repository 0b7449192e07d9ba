"""Importing this module fills the registry."""

from verification import queries_gold, queries_models, queries_records, queries_storage  # noqa: F401
from verification.registry import ORACLES, QUERIES  # noqa: F401
