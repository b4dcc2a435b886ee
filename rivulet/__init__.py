"""rivulet: retail and trading stream analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, so the same code runs on batch tables and, where Spark allows it,
on Structured Streaming inputs.
"""

from rivulet.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
