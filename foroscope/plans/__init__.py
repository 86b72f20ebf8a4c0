from foroscope.plans.registry import ORACLES, QUERIES
from foroscope.plans import activity, clean, graphs, identity, ingest, report, texts, vectors  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
