"""SQL expressions for lines, records, times, attributes and message text.

The functions take column names or SQL text and give SQL text, for `selectExpr` or `functions.expr`.
One text reaches the session in one call, however large the expression is.
"""


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_list(texts) -> str:
    return ", ".join(quoted(t) for t in texts)


def kept_apart(sql: str) -> str:
    """`sql`, marked so that a filter on it is not moved below the projection that computes it.

    A moved filter would carry a copy of the whole expression, and it would be worked out twice.
    """
    return f"CASE WHEN spark_partition_id() >= 0 THEN {sql} END"
