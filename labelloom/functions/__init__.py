"""SQL expression texts, all built in and JVM-side.

Wide labels need dozens of expressions. As text they cross from Python to the JVM once per column
(``selectExpr``) and not once per operator, which keeps building a plan cheap.
"""
