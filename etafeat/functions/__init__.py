"""Column -> Column functions (strings, maths, dates, hashing)."""

from etafeat.functions.columns import *  # noqa: F401,F403
