"""Data quality rules: rows, keys or references that break them."""

from pyspark.sql import functions as F

from driver_queries.registry import query
from skyledger.operators.quality import duplicate_keys, not_null_rules, orphan_keys, row_violations


@query("check_not_null", "SELECT 'not_null_kind' AS rule, event_id, nullif(event_type, 'error') AS kind FROM events WHERE event_type = 'error'")
def check_not_null(t):
    rows = t.events.select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return row_violations(rows, not_null_rules(["event_id", "kind"]))


@query(
    "check_range",
    """
    SELECT 'balance_positive' AS rule, c_custkey, c_acctbal FROM customer WHERE NOT c_acctbal > 0
    UNION ALL
    SELECT 'balance_bounded' AS rule, c_custkey, c_acctbal FROM customer WHERE NOT c_acctbal < 9000
    """,
)
def check_range(t):
    rules = {"balance_positive": F.col("c_acctbal") > 0, "balance_bounded": F.col("c_acctbal") < 9000}
    return row_violations(t.customer.select("c_custkey", "c_acctbal"), rules)


def _shipments(t):
    orders = t.orders.select("o_orderkey", "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_returnflag")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey")


@query(
    "check_order",
    """
    SELECT 'ship_after_order' AS rule, l_orderkey, l_partkey, l_linenumber
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE NOT l_shipdate > o_orderdate
    """,
)
def check_order(t):
    found = row_violations(_shipments(t), {"ship_after_order": F.col("l_shipdate") > F.col("o_orderdate")})
    return found.select("rule", "l_orderkey", "l_partkey", "l_linenumber")


_PAIR = "arrived IS NULL OR (left_at IS NOT NULL AND arrived > left_at)"


@query(
    "check_null_pair",
    f"""
    WITH flown AS (SELECT l_orderkey, l_partkey, l_linenumber,
                          CASE WHEN l_returnflag <> 'N' THEN o_orderdate END AS left_at,
                          CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS arrived
                   FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT 'flown_order' AS rule, l_orderkey, l_partkey, l_linenumber FROM flown WHERE NOT ({_PAIR})
    """,
)
def check_null_pair(t):
    flown = _shipments(t).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("o_orderdate")).alias("left_at"),
        F.when(F.col("l_returnflag") != "A", F.col("l_shipdate")).alias("arrived"),
    )
    return row_violations(flown, {"flown_order": F.expr(_PAIR)}).drop("left_at", "arrived")


@query(
    "check_enum",
    """
    WITH s AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority FROM orders)
    SELECT 'status_known' AS rule, * FROM s WHERE NOT status IN ('F', 'P')
    UNION ALL
    SELECT 'priority_known' AS rule, * FROM s WHERE NOT o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
    """,
)
def check_enum(t):
    """A NULL status breaks no rule."""
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority")
    rules = {
        "status_known": F.col("status").isin("F", "P"),
        "priority_known": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"),
    }
    return row_violations(rows, rules)


@query("check_unique", "SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def check_unique(t):
    return duplicate_keys(t.orders, ["o_custkey"])


@query(
    "check_unique_composite",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_unique_composite(t):
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "check_fk",
    """
    SELECT o_custkey, count(*) AS rows FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0) GROUP BY 1
    """,
)
def check_fk(t):
    """Customers in debt are taken out of the parent, as the data have no orphans."""
    return orphan_keys(t.orders, t.customer.where("c_acctbal >= 0"), ["o_custkey"], ["c_custkey"])


@query(
    "check_fk_composite",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem a
    WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R'
                      AND b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber)
    GROUP BY 1, 2
    """,
)
def check_fk_composite(t):
    return orphan_keys(t.lineitem, t.lineitem.where("l_returnflag = 'R'"), ["l_orderkey", "l_linenumber"])
