"""Scalar and aggregate expressions as SQL text, for ``expr`` and ``selectExpr``.

Arguments and results are SQL text: one call hands a whole expression to the
JVM, where a tree of ``Column`` objects would cost a round trip per node, and
the wide driver queries have thousands of nodes. Everything runs as built-in
Spark expressions.
"""
