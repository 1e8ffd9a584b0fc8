"""Column expressions shared by the jobs (all JVM-side built-ins, no Python UDFs)."""

from .exprs import (blank_to_null, null_date, null_safe_key, unit_cost, money, qty,
                    text_op_after, change_key_part, to_double)

__all__ = ["blank_to_null", "null_date", "null_safe_key", "unit_cost", "money", "qty",
           "text_op_after", "change_key_part", "to_double"]
