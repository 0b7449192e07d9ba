"""Importing this module fills the registry."""

from carelake.llm import queries, queries_graphs  # noqa: F401
from carelake.llm.registry import ORACLES, QUERIES  # noqa: F401
