"""DataFrame -> DataFrame operators.  Stateless ones run unchanged on streams."""
