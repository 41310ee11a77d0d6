"""SQL text helpers for the DuckDB oracle.

They spell out, in plain SQL, the same arithmetic the Spark operators use:
money summed as DECIMAL and turned into DOUBLE, ratios divided as
DOUBLE and rounded half-up on the shortest decimal text of the double (which
is how Spark rounds a DOUBLE).
"""

from __future__ import annotations

from shoplake.sources.bindings import BINDING_SQL


def rnd(expr: str, n: int) -> str:
    """Half-up rounding of a DOUBLE expression, as Spark's ``round`` does it."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mavg(x: str, n: int = 2) -> str:
    return rnd(f"{msum(x)} / COUNT({x})", n)


def dbl(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS DOUBLE)"


def pct(num: str, den: str, n: int = 1) -> str:
    return rnd(f"CAST({num} AS DOUBLE) / NULLIF({den}, 0) * 100", n)


def dwd_sql(statuses=("paid", "shipped", "completed"), min_amount=0) -> str:
    st = ", ".join(f"'{s}'" for s in statuses)
    amount = "" if min_amount is None else f" AND actual_amount > {min_amount}"
    return ("SELECT order_id, user_id, order_status, CAST(order_amount AS DOUBLE) AS order_amount, "
            "CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(actual_amount AS DOUBLE) AS actual_amount, "
            f"payment_method, CAST(order_time AS DATE) AS order_date "
            f"FROM fact_order WHERE order_status IN ({st}){amount}")


def with_ctes(body: str, **ctes: str) -> str:
    """Prefix the business-table bindings (and extra CTEs, in order) to ``body``."""
    parts = [f"{name} AS ({sql})" for name, sql in BINDING_SQL.items()]
    parts += [f"{name} AS ({sql})" for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
