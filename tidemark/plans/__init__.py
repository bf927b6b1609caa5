"""Registered queries; importing this package fills the registry."""

from . import core, explore, files, graphs, learning, matching, shapes, sport  # noqa: F401
from .registry import REGISTRY
