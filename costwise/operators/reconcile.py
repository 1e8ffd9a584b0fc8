"""General-ledger reconciliation: pair debit and credit entries inside a transaction.

Matching rule (per group, e.g. posting day + transaction): take entries in entry
order; an unmatched entry pairs with the first later unmatched entry of another
account whose amount mirrors it (its debit equals the other's credit or vice versa).

Distributed form, no driver loop:
* one-sided entries only match entries of the same amount, so a group splits into
  independent (group, amount) sub-groups;
* when the debit and credit accounts of a sub-group are disjoint, the k-th debit
  pairs with the k-th credit (two ``row_number``s and one equi join);
* amounts that two-sided entries tie together are one sub-group; these, and sub-groups with an account
  on both sides, run the exact scan (``pairing``): near-linear in a sub-group, open entries in first-in queues.

With ``cap=True`` (transactions without item links) the source stops pairing a
transaction once 1 or 3 of its n entries are left: for odd n the last pair (by
first entry) is dropped when all but one entry were paired; even n never stops early.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import stored
from .pairing import connected_amounts, exact_pairs

# Reconciliation types written to the output.
TIP_PAIR = "1D - 1C"
TIP_1D_NC, TIP_NC_1D = "1D - nC", "nC - 1D"
TIP_1C_ND, TIP_ND_1C = "1C - nD", "nD - 1C"
TIP_NONITEM_ERROR = "nonItem error"
TIP_ITEM_LINK = "item link"
TIP_ITEM_ERROR = "Item error"

def match_pairs(rows: DataFrame, keys: Sequence[str], cap: bool) -> DataFrame:
    """Pairs (keys..., e1, e2) with e1 < e2 by the matching rule.

    rows: keys, entry_no (unique in a group), account, debit, credit (decimal(18,2)).
    No step gathers a whole group: which amounts two-sided entries tie together, and which amounts an
    account has on both sides, are grouped flags (combined before the shuffle) joined back, and
    the ranks are taken per (group, amount, side).
    """
    keys = list(keys)
    r = rows.select(*keys, "entry_no", "account", "debit", "credit").withColumn(
        "_amt", F.when(F.col("debit") != 0, F.col("debit")).otherwise(F.col("credit")))
    sub = keys + ["_amt"]
    two = (F.col("debit") != 0) & (F.col("credit") != 0)
    tied = materialize(connected_amounts(r.filter(two), keys), "gl-tied-amounts")
    r = r.join(tied, sub, "left")
    one = r.filter(F.col("_part").isNull()).withColumn("_d", (F.col("debit") != 0).cast("int"))
    shared = (one.groupBy(*sub, "account").agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi"))
              .filter("_lo <> _hi").select(*sub).distinct())
    fast = one.join(shared, sub, "left_anti")
    fast = fast.withColumn("_k", F.row_number().over(Window.partitionBy(*sub, "_d").orderBy("entry_no")))
    d = fast.filter(F.col("_d") == 1).select(*sub, "_k", F.col("entry_no").alias("_de"))
    c = fast.filter(F.col("_d") == 0).select(*sub, "_k", F.col("entry_no").alias("_ce"))
    fast_pairs = d.join(c, sub + ["_k"]).select(*keys, F.least("_de", "_ce").alias("e1"),
                                                F.greatest("_de", "_ce").alias("e2"))
    # a part is named by its amount: tied amounts by the least of them
    both = one.join(shared, sub, "left_semi").withColumn("_part", (F.col("_amt") * 100).cast("long"))
    exact = r.filter(F.col("_part").isNotNull()).unionByName(both.select(*r.columns))
    exact_pairs_ = exact_pairs(exact, keys, "_part")
    pairs = fast_pairs.unionByName(exact_pairs_)
    if not cap:
        return pairs
    n = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    stats = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_np"), F.max("e1").alias("_last"))
    drop = (stats.join(n, keys).filter(((F.col("_n") % 2) == 1) & (F.col("_np") > F.greatest(
        F.lit(0), F.expr("(_n - 3) div 2")))).select(*keys, F.col("_last").alias("e1")))
    return pairs.join(drop, keys + ["e1"], "left_anti")


def _pair_rows(pairs: DataFrame, rows: DataFrame, keys: Sequence[str], tip: str, link: bool = False) -> DataFrame:
    a = rows.select(*keys, *[F.col(c).alias(f"a_{c}") for c in _ROW_COLS])
    b = rows.select(*keys, *[F.col(c).alias(f"b_{c}") for c in _ROW_COLS])
    j = (pairs.join(a.withColumnRenamed("a_entry_no", "e1"), list(keys) + ["e1"])
         .join(b.withColumnRenamed("b_entry_no", "e2"), list(keys) + ["e2"]))

    def side(x, y, ex, ey):
        st = F.coalesce(F.when(F.col(f"{x}_source_type") != 0, F.col(f"{x}_source_type")),
                        F.when(F.col(f"{y}_source_type") != 0, F.col(f"{y}_source_type")))
        sn = F.coalesce(F.when(F.col(f"{x}_source_no") != "", F.col(f"{x}_source_no")),
                        F.when(F.col(f"{y}_source_no") != "", F.col(f"{y}_source_no")))
        return F.struct(
            F.lit(tip).alias("tip"), F.col(ex).alias("entry_no"), F.col(f"{x}_account").alias("account"),
            F.col(ey).alias("bal_entry_no"), F.col(f"{y}_account").alias("bal_account"), st.alias("source_type"),
            sn.alias("source_no"), F.col(f"{x}_debit").alias("debit"), F.col(f"{x}_credit").alias("credit"))

    item_link = F.col("item_link") if link else F.lit(None).cast("string")
    return _both_sides(j, item_link, side("a", "b", "e1", "e2"), side("b", "a", "e2", "e1"))


def _both_sides(joined: DataFrame, item_link, one, other) -> DataFrame:
    """A row of each side for every pair: the pairs are joined once, not once a side."""
    rows = joined.select("posting_date", "transaction_no", item_link.alias("item_link"), F.explode(F.array(one, other)).alias("_side"))
    return rows.select(*[F.col(c if c in rows.columns else f"_side.{c}").alias(c) for c in OUT_COLS])


_ROW_COLS = ("entry_no", "account", "source_type", "source_no", "debit", "credit")
OUT_COLS = ("posting_date", "tip", "transaction_no", "entry_no", "account", "bal_entry_no", "bal_account",
            "source_type", "source_no", "debit", "credit", "item_link")


def _one_to_many(rest: DataFrame, keys, one: str, many: str, tip_one: str, tip_many: str):
    """Transactions with exactly one ``one``-side entry: it against every ``many``-side entry."""
    sel = (rest.groupBy(*keys).agg(F.count_if(F.col(one) != 0).alias("_c")).filter(F.col("_c") == 1)
           .select(*keys))
    tx = rest.join(sel, keys, "left_semi")
    o = tx.filter(F.col(one) != 0).select(*keys, *[F.col(c).alias(f"o_{c}") for c in _ROW_COLS])
    m = tx.filter(F.col(many) != 0).select(*keys, *[F.col(c).alias(f"m_{c}") for c in _ROW_COLS])
    j = o.join(m, list(keys))
    zero = F.lit(0).cast("decimal(18,2)")
    amt = F.col(f"m_{many}")
    one_rows = F.struct(
        F.lit(tip_one).alias("tip"), F.col("o_entry_no").alias("entry_no"),
        F.col("o_account").alias("account"), F.col("m_entry_no").alias("bal_entry_no"),
        F.col("m_account").alias("bal_account"),
        F.coalesce(F.when(F.col("o_source_type") != 0, F.col("o_source_type")), F.col("m_source_type")).alias("source_type"),
        F.coalesce(F.when(F.col("o_source_no") != "", F.col("o_source_no")), F.col("m_source_no")).alias("source_no"),
        (amt if one == "debit" else zero).alias("debit"), (amt if one == "credit" else zero).alias("credit"))
    many_rows = F.struct(
        F.lit(tip_many).alias("tip"), F.col("m_entry_no").alias("entry_no"),
        F.col("m_account").alias("account"), F.col("o_entry_no").alias("bal_entry_no"),
        F.col("o_account").alias("bal_account"),
        F.coalesce(F.when(F.col("m_source_type") != 0, F.col("m_source_type")), F.col("o_source_type")).alias("source_type"),
        F.coalesce(F.when(F.col("m_source_no") != "", F.col("m_source_no")), F.col("o_source_no")).alias("source_no"),
        (amt if many == "debit" else zero).alias("debit"), (amt if many == "credit" else zero).alias("credit"))
    return _both_sides(j, F.lit(None).cast("string"), one_rows, many_rows), rest.join(sel, keys, "left_anti")


def _raw_rows(rest: DataFrame, tip: str, link: bool = False) -> DataFrame:
    return rest.select("posting_date", F.lit(tip).alias("tip"), "transaction_no", "entry_no", "account",
                       F.lit(None).cast("long").alias("bal_entry_no"), F.lit(None).cast("string").alias("bal_account"),
                       "source_type", "source_no", "debit", "credit",
                       (F.col("item_link") if link else F.lit(None).cast("string")).alias("item_link"))


def link_keys(entries: DataFrame, relations: DataFrame) -> DataFrame:
    """(entry_no, item_link): the entry's value-entry numbers, ascending, comma separated."""
    j = entries.select("entry_no").join(relations.select(F.col("gl_entry_no").alias("entry_no"), "value_entry_no"),
                                        "entry_no")
    return j.groupBy("entry_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list("value_entry_no")),
                                                              lambda v: v.cast("string")), ",").alias("item_link"))


KEYS = ["posting_date", "transaction_no"]


def scoped(entries: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """{'scope': entries with an amount and their link key, 'links': per-entry link keys}."""
    scope = entries.filter((F.col("debit") != 0) | (F.col("credit") != 0))
    links = materialize(link_keys(scope, relations), "gl-links")
    return {"scope": materialize(scope.join(links, "entry_no", "left"), "gl-scope"), "links": links}


def _branches(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries of transactions without item links, and of those with."""
    item_tx = s.filter(F.col("item_link").isNotNull()).select(*KEYS).distinct()
    return s.join(item_tx, KEYS, "left_anti"), s.join(item_tx, KEYS, "left_semi")


def nonitem_branch(s: DataFrame) -> dict[str, DataFrame]:
    """{'rows': reconciliation rows of transactions without item links, 'rest': their entries without a pair}."""
    keys, (nonitem, _) = KEYS, _branches(s)
    pairs = materialize(match_pairs(nonitem, keys, cap=True), "gl-pairs")
    paired = _pair_rows(pairs, nonitem, keys, TIP_PAIR)
    used = pairs.select(*keys, F.col("e1").alias("entry_no")).unionByName(
        pairs.select(*keys, F.col("e2").alias("entry_no")))
    rest1 = materialize(nonitem.join(used, keys + ["entry_no"], "left_anti"), "gl-rest")
    d_rows, rest2 = _one_to_many(rest1, keys, "debit", "credit", TIP_1D_NC, TIP_NC_1D)
    c_rows, rest3 = _one_to_many(rest2, keys, "credit", "debit", TIP_1C_ND, TIP_ND_1C)
    rows = (paired.unionByName(d_rows).unionByName(c_rows)
            .unionByName(_raw_rows(rest3, TIP_NONITEM_ERROR)).select(*OUT_COLS))
    return {"rows": rows, "rest": rest1}


def item_branch(s: DataFrame) -> DataFrame:
    """Reconciliation rows of the linked entries."""
    linked = _branches(s)[1].filter(F.col("item_link").isNotNull())
    lkeys = KEYS + ["item_link"]
    lpairs = materialize(match_pairs(linked, lkeys, cap=False), "gl-link-pairs")
    lrows = _pair_rows(lpairs, linked, lkeys, TIP_ITEM_LINK, link=True)
    lused = lpairs.select(*lkeys, F.col("e1").alias("entry_no")).unionByName(
        lpairs.select(*lkeys, F.col("e2").alias("entry_no")))
    item_err = _raw_rows(linked.join(lused, lkeys + ["entry_no"], "left_anti"), TIP_ITEM_ERROR, link=True)
    return lrows.unionByName(item_err).select(*OUT_COLS)


def balance_gates(s: DataFrame, rest1: DataFrame, result: DataFrame) -> DataFrame:
    """Violations of the seven balance gates by the entries in scope, those without a pair and the written result."""
    keys, (nonitem, item) = KEYS, _branches(s)

    def unbalanced(df, gate):
        return (df.groupBy(*keys).agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
                .filter(F.col("debit") != F.col("credit")).select(F.lit(gate).alias("gate"), *keys, "debit", "credit"))

    done = result.select("posting_date", "entry_no").distinct()

    def left(df, gate):
        """Entries of ``df`` without a row in the result, by transaction."""
        return (df.join(done, ["posting_date", "entry_no"], "left_anti").groupBy(*keys)
                .agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit")).select(F.lit(gate).alias("gate"), *keys, "debit", "credit"))

    nonitem_tips = [TIP_PAIR, TIP_1D_NC, TIP_NC_1D, TIP_1C_ND, TIP_ND_1C, TIP_NONITEM_ERROR]
    unlinked = item.filter(F.col("item_link").isNull())
    return (unbalanced(rest1, "non-item remainder unbalanced")
            .unionByName(unbalanced(result.filter(F.col("tip").isin(nonitem_tips)), "non-item result unbalanced"))
            .unionByName(unbalanced(item, "item transactions unbalanced"))
            .unionByName(unlinked.groupBy(*keys).agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
                         .select(F.lit("entries without link").alias("gate"), *keys, "debit", "credit"))
            .unionByName(unbalanced(result.filter(~F.col("tip").isin(nonitem_tips)), "item result unbalanced"))
            .unionByName(left(nonitem, "non-item entries left"))
            .unionByName(left(s, "entries left")))


def reconcile(entries: DataFrame, relations: DataFrame, parts: Sequence[str] = ("nonitem", "item", "gates")
              ) -> dict[str, DataFrame]:
    """Reconcile G/L entries of every posting day at once (posting date is in every key).

    entries: posting_date, transaction_no, entry_no, account, source_type, source_no, debit, credit.
    relations: gl_entry_no, value_entry_no.
    Returns {'result': reconciliation rows, 'gates': balance-gate violations,
             'links': per-entry link keys}. ``parts`` limits the work to the non-item
    and/or item branch (the gates need both).
    """
    parts = set(parts)
    if "gates" in parts:
        parts |= {"nonitem", "item"}
    s, links = scoped(entries, relations).values()
    result = _raw_rows(s.filter(F.lit(False)), TIP_NONITEM_ERROR)
    if "nonitem" in parts:
        rows, rest1 = nonitem_branch(s).values()
        result = result.unionByName(rows)
    if "item" in parts:
        result = result.unionByName(item_branch(s))
    if "gates" not in parts:
        return {"result": result, "gates": None, "links": links}
    # the gates read the staged rows, and so does who publishes them: the result is computed once
    result = materialize(result, "gl-staged")
    return {"result": result, "gates": balance_gates(s, rest1, result), "links": links}


class UnbalancedError(ValueError):
    """A balance gate is violated."""


def month_range(year: int, month: int, start_day: int = 1, end_day: int | None = None) -> tuple[dt.date, dt.date]:
    """First and last day to reconcile; anything outside the month, or a start after the end, is an error."""
    if not (1 <= month <= 12) or year < 1:
        raise ValueError(f"no such month: {year}-{month}")
    last = calendar.monthrange(year, month)[1]
    end_day = last if end_day is None else end_day
    if start_day < 1 or end_day > last or start_day > end_day:
        raise ValueError(f"bad days {start_day}..{end_day} for {year}-{month:02d}")
    return dt.date(year, month, start_day), dt.date(year, month, end_day)


def reconcile_month(entries: DataFrame, relations: DataFrame, year: int, month: int, start_day: int = 1,
                    end_day: int | None = None, path: str | None = None, strict: bool = True) -> DataFrame:
    """Reconcile the days of one month as one job (no day loop).

    ``strict``: all seven balance gates are checked on the staged rows; a violated one raises ``UnbalancedError`` and nothing is
    published, as in the source. ``path``: the days there (``stored.publish``) are replaced by the staged rows in one step;
    days without rows keep what they had. A rerun publishes the same rows again.
    """
    first, last = month_range(year, month, start_day, end_day)
    days = entries.filter(F.col("posting_date").between(F.lit(first), F.lit(last)))
    out = reconcile(days, relations, ("gates",) if strict else ("nonitem", "item"))
    if strict:
        bad = out["gates"].limit(5).collect()
        if bad:
            raise UnbalancedError("; ".join(f"{r['gate']}: {r['posting_date']} {r['transaction_no']}" for r in bad))
    if path:
        stored.publish(out["result"], path, "posting_date")
    return out["result"]
