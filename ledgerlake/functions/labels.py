"""Funder-report labels: priority, product type and funder."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values: funder labels, ordered substring tests (case-sensitive) ------
FUNDER_RULES: list[tuple[list[str], str]] = [
    (["OFD", "Servicer"], "OFD"),
    (["Key"], "Key"),
    (["Banc of Ame", "Bank of Ame"], "BAL_US"),
    (["BAL Global Finance Canada"], "BAL_CA"),
    (["SG E"], "SG"),
    (["Wells Fa"], "WF"),
    (["Dext"], "DEXT"),
]
FUNDER_OTHER = "Others"

# ---- fixed values: priority rules ----------------------------------------------
CLOUD_ASSIGNEE_TEXT = "OFD Cloud"
PRIORITY_CLOUD_DAYS = 60
PRIORITY_AMOUNT = 1000000
PRIORITY_OLD_DAYS = 90


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def priority(assignee, days, open_amt) -> Column:
    a, d, amt = _c(assignee), _c(days), _c(open_amt)
    cloud = F.coalesce(a.contains(CLOUD_ASSIGNEE_TEXT), F.lit(False))
    return (F.when(cloud & (d > PRIORITY_CLOUD_DAYS), "P1_C60")
            .when(amt > PRIORITY_AMOUNT, "P1_1M")
            .when(d > PRIORITY_OLD_DAYS, "P1_90D")
            .when(d > 0, "P2")
            .otherwise("P3"))


def product_type(order_number) -> Column:
    """'ns' anywhere (any case) -> NetSuite; otherwise, also when missing, Oracle."""
    return F.when(F.coalesce(F.lower(_c(order_number)).contains("ns"), F.lit(False)), "NetSuite").otherwise("Oracle")


def funder_label(name) -> Column:
    n = _c(name)
    expr = None
    for needles, label in FUNDER_RULES:
        cond = None
        for s in needles:
            cond = n.contains(s) if cond is None else (cond | n.contains(s))
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(FUNDER_OTHER)
