"""Expression helpers.

They take and return SQL text, which operators hand to ``selectExpr`` and ``expr``:
a whole projection then reaches the JVM in one call.
"""
