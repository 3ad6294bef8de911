"""Column expressions shared by batch and streaming operators (all JVM-side)."""

from adsieve.functions.expressions import *  # noqa: F401,F403
