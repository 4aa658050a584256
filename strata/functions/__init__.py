"""Column expressions (JVM-side, codegen-friendly); no Python UDF here."""

from strata.functions.expressions import *  # noqa: F401,F403
