"""Incremental loading and dimensional modelling as plain PySpark operators."""

from strata.specs import FieldMapping, LoadSpec, specs_from_config

__all__ = ["FieldMapping", "LoadSpec", "specs_from_config"]
