"""DuckDB SQL used as the correctness oracle for the Spark operators.

The adapter views are written as CTEs named ``r_*`` (so they never shadow the source
tables ``orders`` / ``supplier``), and every oracle query is prefixed with them.
"""
