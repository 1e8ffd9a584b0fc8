"""Column expressions.

Conventions of the ERP data handled here:
* an empty string means "no value" (``blank_to_null``), and null keys match each
  other through a sentinel in some joins (``null_safe_key``);
* 1753-01-01 is the ERP's null date (``null_date``);
* quantities and factors are exact decimals (``qty``: decimal(18,9)), money is
  decimal(18,2) while summing (``money``); products are cast back after every
  binary operation so Spark keeps the scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's.
NULL_DATE = "1753-01-01"
NULL_KEY = "_null"
COST_TYPE_ESTIMATE = "Cifraj"
COST_TYPE_LAST_DIRECT = "NAV Last Direct Cost"
COST_TYPE_UNIT = "NAV Unit Cost"
COST_TYPE_STANDARD = "NAV Standard Cost"
COST_TYPE_PURCHASE = "NAV Last Purchase Price"
COST_TYPE_LEGACY = "Legacy Unit Cost"
COST_TYPE_NONE = "No Unit Cost"

QTY = "decimal(18,9)"
MONEY = "decimal(18,2)"
COST = "decimal(15,5)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """``nullif(x, '')``."""
    c = _c(c)
    return F.when(c != F.lit(""), c)


def null_safe_key(c) -> Column:
    """``coalesce(nullif(x, ''), '_null')``: blank and null keys join to each other."""
    return F.coalesce(blank_to_null(c), F.lit(NULL_KEY))


def null_date(c) -> Column:
    """``nullif(d::date, '1753-01-01')``."""
    d = _c(c).cast("date")
    return F.when(d != F.lit(NULL_DATE).cast("date"), d)


def qty(c) -> Column:
    return _c(c).cast(QTY)


def money(c) -> Column:
    return _c(c).cast(MONEY)


def to_double(c) -> Column:
    return _c(c).cast("double")


def unit_cost(nav_unit, nav_standard, nav_last_direct, estimate, last_purchase, legacy) -> Column:
    """Unit-cost selection: struct<unit_cost_type string, unit_cost decimal(15,5)>.

    Order of preference with the source's tie rules: estimate; last direct cost if
    >= unit and >= standard; unit cost if >= standard and > last direct; standard if
    > unit and > last direct; last purchase price; legacy; else 'No Unit Cost' / 0.
    One CASE chain, evaluated inside whole-stage codegen.
    """
    z = F.lit(0)
    u, s, d = F.coalesce(_c(nav_unit), z), F.coalesce(_c(nav_standard), z), F.coalesce(_c(nav_last_direct), z)
    e, p, g = F.coalesce(_c(estimate), z), F.coalesce(_c(last_purchase), z), F.coalesce(_c(legacy), z)
    pairs = [
        (e != 0, COST_TYPE_ESTIMATE, estimate),
        ((d != 0) & (d >= u) & (d >= s), COST_TYPE_LAST_DIRECT, nav_last_direct),
        ((u != 0) & (u >= s) & (u > d), COST_TYPE_UNIT, nav_unit),
        ((s != 0) & (s > u) & (s > d), COST_TYPE_STANDARD, nav_standard),
        (p != 0, COST_TYPE_PURCHASE, last_purchase),
        (g != 0, COST_TYPE_LEGACY, legacy),
    ]
    kind = F.when(pairs[0][0], F.lit(pairs[0][1]))
    cost = F.when(pairs[0][0], _c(pairs[0][2]).cast(COST))
    for cond, label, col in pairs[1:]:
        kind = kind.when(cond, F.lit(label))
        cost = cost.when(cond, _c(col).cast(COST))
    kind = kind.otherwise(F.lit(COST_TYPE_NONE))
    cost = cost.otherwise(F.lit(0).cast(COST))
    return F.struct(kind.alias("unit_cost_type"), cost.alias("unit_cost"))


def text_op_after(op, counted, numeric: bool = False) -> Column:
    """Operation ``op`` comes after the ``counted`` one.

    Operation numbers are text and compare as text by default ('90' > '110').
    ``numeric=True`` compares digit-only values as integers (others never match).
    """
    a, b = _c(op), _c(counted)
    if not numeric:
        return a > b.cast("string")
    return F.when(a.rlike(r"^\d+$"), a.cast("long") > b.cast("long")).otherwise(F.lit(False))


def change_key_part(primary_key, n: int) -> Column:
    """The n-th (1-based) non-empty bracketed value of a change-log primary-key text, or null.

    Empty brackets do not count, as in the source.

    ``'Field1=CONST(A),Field2=CONST(10000)'`` -> part 2 is ``'10000'``.
    """
    parts = F.regexp_extract_all(_c(primary_key), F.lit(r"\(([^)]+)\)"), 1)
    return F.try_element_at(parts, F.lit(n))
