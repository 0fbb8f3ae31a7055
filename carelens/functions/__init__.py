"""Column functions as Spark SQL expression text.

Each function takes expression texts (a column name is one) and gives an expression text, for ``selectExpr``, ``where``
or ``F.expr``.  All of them are native expressions.  A report holds over a thousand of them; as text they are parsed in
the JVM in one call each instead of being put together call by call.
"""
