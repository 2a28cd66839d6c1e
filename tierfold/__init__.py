"""Layered record processing on Spark: raw documents -> clean tables -> marts."""

from tierfold.config import LakeConfig
from tierfold.session import build_session

__all__ = ["LakeConfig", "build_session"]
