"""Column expressions shared by the operators (all JVM-side built-ins)."""

from orderlake.functions.columns import *  # noqa: F401,F403
