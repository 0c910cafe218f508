"""Column -> Column functions (all JVM-side built-ins, no Python UDFs)."""

from farelake.functions.columns import *  # noqa: F401,F403
from farelake.functions.columns import __all__  # noqa: F401
