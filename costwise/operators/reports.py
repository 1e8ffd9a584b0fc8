"""Ledger reports with their dimension tables as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reconcile import TIP_1C_ND, TIP_1D_NC


def named(df: DataFrame, dims: dict[str, tuple[Column, DataFrame]]) -> DataFrame:
    """``df`` with a name for each output column: (key expression, dimension (code, name)). Codes without a row stay unnamed; a
    dimension has one row a code, so no row is repeated."""
    for i, (out, (key, dim)) in enumerate(dims.items()):
        df = df.join(dim.select(F.col("code").cast("string").alias(f"_c{i}"), F.col("name").alias(out)), key.cast("string") == F.col(f"_c{i}"), "left").drop(f"_c{i}")
    return df


def reconciled_report(entries: DataFrame, result: DataFrame, accounts: DataFrame, doc_types: DataFrame, source_types: DataFrame,
                      fa_types: DataFrame, customers: DataFrame, vendors: DataFrame) -> DataFrame:
    """Reconciliation rows with the facts of their G/L entries, names of accounts, documents, sources and fixed-asset types, and
    amounts in home and foreign currency.

    entries: (entry_no, transaction_no, bal_account_no, document_date, document_type, document_no, external_document_no, description,
    debit_fcy, credit_fcy, currency, dimension_1, dimension_2, source_code, dimension_set_id, fa_entry_type, fa_entry_no); result: rows of
    ``reconcile``. One against many takes amount and currency of each of the many, so the foreign amount comes from that entry too.
    """
    one = F.col("tip").isin(TIP_1D_NC, TIP_1C_ND)
    fcy = entries.select(F.col("entry_no").alias("_amt_no"), F.col("debit_fcy").alias("_fd"), F.col("credit_fcy").alias("_fc"),
                         F.col("currency").alias("currency_code"))
    zero = F.lit(0).cast("decimal(18,2)")
    facts = entries.drop("transaction_no", "debit_fcy", "credit_fcy", "currency")
    rows = (result.withColumn("_amt_no", F.when(one, F.col("bal_entry_no")).otherwise(F.col("entry_no"))).join(fcy, "_amt_no", "left")
            .withColumn("debit_fcy", F.when(F.col("tip") == TIP_1D_NC, F.col("_fc")).when(F.col("tip") == TIP_1C_ND, zero).otherwise(F.col("_fd")))
            .withColumn("credit_fcy", F.when(F.col("tip") == TIP_1C_ND, F.col("_fd")).when(F.col("tip") == TIP_1D_NC, zero).otherwise(F.col("_fc")))
            .join(facts, "entry_no"))
    rows = named(rows, {
        "account_name": (F.col("account"), accounts), "offset_account_name": (F.col("bal_account"), accounts),
        "document_type_name": (F.col("document_type"), doc_types), "source_type_name": (F.col("source_type"), source_types),
        "fa_entry_type_name": (F.col("fa_entry_type"), fa_types),
        "_customer": (F.when(F.col("source_type") == 1, F.col("source_no")), customers),
        "_vendor": (F.when(F.col("source_type") == 2, F.col("source_no")), vendors)})
    return rows.select(
        "posting_date", "transaction_no", "entry_no", "account", "account_name", "bal_account_no", F.col("bal_account").alias("offset_account"),
        "offset_account_name", "document_date", "document_type_name", "document_no", "external_document_no", "description",
        (F.col("debit") - F.col("credit")).alias("amount"), "debit", "credit", (F.col("debit_fcy") - F.col("credit_fcy")).alias("amount_fcy"),
        "debit_fcy", "credit_fcy", "currency_code", "dimension_1", "dimension_2", "source_code", "source_type_name", "source_no",
        F.coalesce("_customer", "_vendor").alias("source_name"), "dimension_set_id", "fa_entry_type_name", "fa_entry_no", "tip")


def values_synchronised(values: DataFrame, day, dims: dict[str, DataFrame]) -> DataFrame:
    """Value entries synchronised on a day with the names of their five codes: ``dims`` by code column of ``values``."""
    rows = values.filter(F.col("sync_date") == F.lit(day).cast("date")).drop("sync_date")
    return named(rows, {f"{code}_name": (F.col(code), dim) for code, dim in dims.items()}).drop(*dims)


def unlinked_values(values: DataFrame, relations: DataFrame, entries: DataFrame, start, end, dims: dict[str, DataFrame]) -> DataFrame:
    """Value entries of a period that no G/L entry of the period is linked to, with their names and the posting dates of G/L entries of other
    days they are linked to. Only the relations of those values are looked up."""
    inside = lambda c: F.col(c).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    of_period = entries.filter(inside("posting_date")).select(F.col("entry_no").alias("gl_entry_no"))
    linked = relations.join(of_period, "gl_entry_no", "left_semi").select(F.col("value_entry_no").alias("entry_no"))
    open_ = values.filter(inside("posting_date")).join(linked, "entry_no", "left_anti")
    open_ = named(open_, {f"{code}_name": (F.col(code), dim) for code, dim in dims.items()}).drop(*dims)
    later = relations.join(open_.select(F.col("entry_no").alias("value_entry_no")), "value_entry_no", "left_semi").join(
        entries.select(F.col("entry_no").alias("gl_entry_no"), F.col("posting_date").alias("gl_posting_date")), "gl_entry_no", "left")
    return open_.join(later.select(F.col("value_entry_no").alias("entry_no"), "gl_posting_date"), "entry_no", "left")
