"""Registered queries: import the modules so they register themselves."""

from petalframe.plans import q_checks, q_drift, q_io, q_metrics, q_misc, q_models, q_online, q_pit, q_sampling, q_shap, q_stream  # noqa: F401
from petalframe.plans.registry import ORACLE, QUERIES  # noqa: F401
