"""Column-expression helpers; all JVM-side so they stay in whole-stage codegen."""

from classbench.functions.scalar import *  # noqa: F401,F403
