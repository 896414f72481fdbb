"""Folders for what the queries write on their way."""

from upkeep.session import shared_path as scratch

__all__ = ["scratch"]
