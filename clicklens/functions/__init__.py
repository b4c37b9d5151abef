"""Column-expression helpers (dates, ratios, lists, records)."""

from clicklens.functions.columns import *  # noqa: F401,F403
