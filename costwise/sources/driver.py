"""ERP-shaped views derived from the driver tables (TPC-H-like parquet).

The jobs in ``costwise.operators`` are generic over column names; these views give
them production data shapes built from the driver tables, so every registered query
reads whole tables and its work grows with them:

* items: ``part`` (item no = part key; posting group = part type; unit cost = retail price)
* item ledger / value entries: ``lineitem`` (signed quantities; entry type from the
  return flag and line status)
* production orders: ``orders``; production order lines / components: ``lineitem``
* production BOM: part p has lines to parts 2p+1 and 2p+2 (a binary tree over the
  part table), kits (assembly BOMs): PROMO parts with parts k+1, k+2 as components
* G/L entries: one per line item; transaction = order, posting day = order date
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Tables

# Fixed values of the ERP code lists used below.
ENTRY_PURCHASE, ENTRY_SALE, ENTRY_CONSUMPTION, ENTRY_OUTPUT, ENTRY_ASSEMBLY = 0, 1, 5, 6, 9
STATUS_PLANNED, STATUS_RELEASED, STATUS_FINISHED = 2, 3, 4


def entry_type(flag: Column, status: Column) -> Column:
    return (F.when(flag == "R", F.lit(ENTRY_SALE))
            .when(flag == "A", F.lit(ENTRY_CONSUMPTION))
            .when(status == "O", F.lit(ENTRY_PURCHASE))
            .otherwise(F.lit(ENTRY_OUTPUT)))


def signed(kind: Column, value: Column) -> Column:
    return F.when(kind.isin(ENTRY_SALE, ENTRY_CONSUMPTION), -value).otherwise(value)


def items(t: Tables) -> DataFrame:
    p = t.part
    return p.select(
        F.col("p_partkey").alias("item_no"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("posting_group"),
        F.col("p_brand").alias("item_range"),
        F.lit("UN").alias("base_uom"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_cost"),
        F.col("p_size").alias("size"),
    )


def item_ledger(t: Tables) -> DataFrame:
    """Item ledger entries: one per line item, quantity and cost signed by entry type."""
    l = t.lineitem
    kind = entry_type(F.col("l_returnflag"), F.col("l_linestatus"))
    return l.select(
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").alias("order_line_no"),
        F.col("l_partkey").alias("item_no"),
        F.concat(F.lit("L"), (F.col("l_suppkey") % 4).cast("string")).alias("location_code"),
        F.concat(F.lit("B"), F.col("l_linenumber").cast("string")).alias("bin_code"),
        F.col("l_linestatus").alias("lot_no"),
        F.col("l_shipdate").cast("date").alias("posting_date"),
        kind.alias("entry_type"),
        signed(kind, F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"),
        signed(kind, F.col("l_extendedprice").cast("decimal(18,2)")).alias("cost_amount"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)"))
        .alias("cost_expected"),
        F.col("l_suppkey").alias("supplier_no"),
    )


def family_ledger(t: Tables) -> DataFrame:
    """The line items booked on the first part of each family of four, the families' movements starting one after the other: parts without
    a movement, and parts whose first one is late, exist."""
    part = F.col("l_partkey")
    return t.lineitem.select((part - part % 4).alias("item_no"),
                             F.date_add(F.col("l_shipdate").cast("date"), (F.floor(part / 4) % 10 * 300).cast("int")).alias("posting_date"))


def entry_posting_group(suppkey: Column) -> Column:
    return (F.when(suppkey % 3 == 0, F.lit("PF")).when(suppkey % 3 == 1, F.lit("MAT_PRIMA"))
            .otherwise(F.lit("SEMIFABR")))


# Total order of the line items of one order: the documented key first, then every other
# column, because (order, part, supplier, line number) repeats in the smaller tables.
LINE_ORDER = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate")


#: Room for the entries of one transaction; a larger one is an error, never a wrong number.
ENTRY_STEP = 1_000_000_000


def entry_numbered(df: DataFrame, txn: str = "l_orderkey") -> DataFrame:
    """Entry number inside a transaction: row_number over the line's unique key
    (a window partitioned by the transaction, never a global one)."""
    w = Window.partitionBy(txn).orderBy(*LINE_ORDER)
    n = F.row_number().over(w)
    n = F.when(n < ENTRY_STEP, n).otherwise(F.raise_error(F.lit("transaction with too many entries")).cast("int"))
    return df.withColumn("entry_no", F.col(txn) * ENTRY_STEP + n)


def gl_entries(t: Tables, period: tuple[str, str] | None = None) -> DataFrame:
    """G/L entries: one per line item. Transaction = order, posting day = order date.

    Debit side: returned lines and open normal lines, account 6x; the others credit,
    account 7x (x = supplier mod 5). Lines without discount carry no amount (dropped
    by the reconciliation scope). Source type cycles 0/1/2 (none/customer/vendor).
    ``period`` filters the orders by day before the entries are numbered (numbers are per
    transaction, so they do not change) and reaches the scan.
    """
    o = t.orders.select("o_orderkey", "o_orderdate", "o_custkey")
    if period:
        o = o.filter(F.col("o_orderdate").cast("date").between(*[F.lit(x).cast("date") for x in period]))
    l = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    l = entry_numbered(l)
    ds = (F.col("l_returnflag") == "R") | ((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))
    amt = F.col("l_quantity").cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    st = (F.col("l_linenumber") % 3).cast("int")
    return l.select(
        F.col("o_orderdate").cast("date").alias("posting_date"), F.col("l_orderkey").alias("transaction_no"),
        "entry_no",
        F.concat(F.when(ds, F.lit("6")).otherwise(F.lit("7")), (F.col("l_suppkey") % 5).cast("string")).alias("account"),
        st.alias("source_type"),
        F.when(st == 1, F.col("o_custkey").cast("string")).when(st == 2, F.col("l_suppkey").cast("string"))
        .otherwise(F.lit("")).alias("source_no"),
        F.when(F.col("l_discount") == 0, zero).when(ds, amt).otherwise(zero).alias("debit"),
        F.when(F.col("l_discount") == 0, zero).when(ds, zero).otherwise(amt).alias("credit"),
        F.col("l_partkey").alias("part_no"))


def gl_item_relations(gl: DataFrame) -> DataFrame:
    """Value-entry links: parts divisible by 3 link to one of two value entries of the
    order, parts divisible by 12 also to a third."""
    a = gl.filter(F.col("part_no") % 3 == 0).select(
        F.col("entry_no").alias("gl_entry_no"),
        (F.col("transaction_no") * 10 + F.col("part_no") % 2).alias("value_entry_no"))
    b = gl.filter(F.col("part_no") % 12 == 0).select(
        F.col("entry_no").alias("gl_entry_no"), (F.col("transaction_no") * 10 + 5).alias("value_entry_no"))
    return a.unionByName(b)


def gl_balanced(gl: DataFrame) -> DataFrame:
    """The entries and for each a counter entry on an account of its own: every transaction balances."""
    first = F.substring("account", 1, 1)
    mirror = F.concat(F.when(first == "6", F.lit("8")).otherwise(F.lit("9")), F.substring("account", 2, 9))
    counter = gl.withColumn("entry_no", F.col("entry_no") + ENTRY_STEP // 2).withColumn("account", mirror).withColumn(
        "_d", F.col("debit")).withColumn("debit", F.col("credit")).withColumn("credit", F.col("_d")).drop("_d")
    return gl.unionByName(counter)


def gl_whole_relations(gl: DataFrame) -> DataFrame:
    """Value-entry links of all entries of every third transaction, so that none of its entries is without a link."""
    return gl.filter(F.col("transaction_no") % 3 == 0).select(
        F.col("entry_no").alias("gl_entry_no"), (F.col("transaction_no") * 10 + F.col("part_no") % 2).alias("value_entry_no"))


# --- production orders, order lines, routing lines, components, capacity ledger ---------------

def prod_orders(t: Tables) -> DataFrame:
    """Production orders: one per order (O -> released, F -> finished, P -> planned)."""
    return t.orders.select(
        F.col("o_orderkey").alias("order_no"),
        F.when(F.col("o_orderstatus") == "O", STATUS_RELEASED).when(F.col("o_orderstatus") == "F", STATUS_FINISHED)
        .otherwise(STATUS_PLANNED).alias("status"),
        F.concat(F.lit("L"), (F.col("o_custkey") % 4).cast("string")).alias("location_code"),
        F.col("o_orderdate").cast("date").alias("last_modified"),
        F.concat(F.lit("PK"), F.col("o_custkey").cast("string")).alias("source_no"),
        F.col("o_orderpriority").alias("description"))


def prod_order_lines(t: Tables) -> DataFrame:
    l = t.lineitem
    return l.select(F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("item_no"),
                    F.concat(F.lit("L"), (F.col("l_suppkey") % 4).cast("string")).alias("location_code"),
                    F.col("l_quantity").cast("decimal(18,2)").alias("quantity"))


def _link(k: Column) -> Column:
    return F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("RL"), (k % 3).cast("string")))


def order_routing(t: Tables) -> DataFrame:
    """Order routing lines: operation numbers are text (0, 15, ..., 90)."""
    l = t.lineitem
    return l.select(F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("routing_ref"),
                    ((F.col("l_partkey") % 7) * 15).cast("string").alias("operation_no"),
                    F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.lit("X")).alias("next_operation_no"),
                    _link(F.col("l_partkey")).alias("link_code"),
                    F.concat(F.lit("WC"), (F.col("l_partkey") % 4).cast("string")).alias("work_center"),
                    F.concat(F.lit("L"), (F.col("l_suppkey") % 4).cast("string")).alias("location_code"))


def capacity_ledger(t: Tables) -> DataFrame:
    l = t.lineitem
    return l.select(F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_linenumber").alias("routing_ref"),
                    ((F.col("l_suppkey") % 7) * 15).cast("string").alias("operation_no"),
                    F.col("l_shipdate").cast("date").alias("posting_date"),
                    F.col("l_quantity").cast("decimal(18,2)").alias("output_qty"),
                    (F.col("l_tax").cast("decimal(18,2)") * 100).cast("decimal(18,2)").alias("scrap_qty"),
                    F.concat(F.lit("WC"), (F.col("l_suppkey") % 4).cast("string")).alias("work_center"),
                    F.concat(F.lit("M"), (F.col("l_suppkey") % 10).cast("string")).alias("machine_no"),
                    (F.col("l_discount").cast("decimal(18,2)") * 10).cast("decimal(18,2)").alias("workers_qty"))


def order_components(t: Tables) -> DataFrame:
    l = t.lineitem
    return l.select(F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("order_line_no"),
                    F.col("l_partkey").alias("item_no"),
                    F.concat(F.lit("L"), (F.col("l_suppkey") % 4).cast("string")).alias("location_code"),
                    (F.col("l_discount").cast("decimal(18,2)") * 100).cast("decimal(18,9)").alias("quantity_per"),
                    F.when(F.col("l_partkey") % 5 == 0, F.lit("BOX")).otherwise(F.lit("UN")).alias("uom"),
                    _link(F.col("l_suppkey")).alias("link_code"))


def stock_differences(t: Tables) -> DataFrame:
    """Counted stock differences (caller-supplied in the source): one per part."""
    return t.part.select(
        F.concat(F.lit("L"), (F.col("p_partkey") % 4).cast("string")).alias("locatie"),
        F.col("p_partkey").alias("reper"),
        F.when(F.col("p_partkey") % 2 == 0, F.lit("BOX")).otherwise(F.lit("UN")).alias("umas"),
        F.lit("minus").alias("tip"), F.col("p_size").cast("decimal(20,2)").alias("cantitate"))
