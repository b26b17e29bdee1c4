"""Instalment-spending analytics on Spark DataFrames."""

from spendlens.params import Params
from spendlens.plans.workspace import Workspace

__all__ = ["Params", "Workspace"]
