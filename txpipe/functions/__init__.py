"""Column expressions (JVM-side, codegen) used across the operators."""

from txpipe.functions.columns import *  # noqa: F401,F403
