from millrace.plans import evaluation, learning, preparation  # noqa: F401
from millrace.plans.registry import ORACLE, QUERIES  # noqa: F401
