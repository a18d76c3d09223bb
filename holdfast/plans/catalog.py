"""All registered queries; importing a module registers its queries."""

from holdfast.plans import checks, distributions, learning, monitoring, personal_data, preparation, relational, scoring, serving, storage, student_run  # noqa: F401
from holdfast.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
