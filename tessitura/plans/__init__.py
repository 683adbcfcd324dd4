"""Registered queries, family by family."""

from . import cleaning, describing, editing, files, finding, inputs, naming, reporting, speakers, streams, times  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
