"""Column-expression helpers (all JVM built-ins, no Python UDFs)."""
from .scalar import *  # noqa: F401,F403
