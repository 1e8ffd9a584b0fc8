"""Query op9: all documents in 40 shards whose row counts differ by at most one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sharding import PRIME, ROUNDS, assign_shards
from .tables import documents

SHARDS, SEED = 40, 20240601


def op9_shards(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    return assign_shards(docs, ["doc_id", "text_crc32", "size"], SHARDS, SEED).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _sql() -> str:
    """The law restated with recursion: crc32 by its bit rule, then the walk step by step."""
    def net(value: str, tag: str) -> tuple[str, str]:
        """SQL of one pass as nested select items (l0, r0) .. (l6, r6)."""
        steps, l, r = [f"{value} // b {tag}l0, {value} % b {tag}r0"], f"{tag}l0", f"{tag}r0"
        for i, (m, c) in enumerate(ROUNDS):
            other = r if i % 2 == 0 else l
            z = f"(({other} + {c} + {SEED}) % {PRIME})"
            f = f"((({z} * {z}) % {PRIME}) * {m} + {c}) % {PRIME}"
            if i % 2 == 0:
                steps.append(f"({l} + {f}) % a {tag}l{i + 1}")
                l = f"{tag}l{i + 1}"
            else:
                steps.append(f"({r} + {f}) % b {tag}r{i + 1}")
                r = f"{tag}r{i + 1}"
        return ", ".join(steps), f"{l} * b + {r}"

    items, result = net("x", "")
    return f"""
with recursive crc_table as (
  select i, list_reduce(range(0, 9), lambda c, k: case when k = 0 then c when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i::bigint) v
  from range(256) t(i)),
crc as (select list(v order by i) tab from crc_table),
h as (select doc_id, coalesce(text, '') t, hex(encode(coalesce(text, ''))) hx from documents),
d as (select doc_id, (octet_length(encode(t)) + 16)::bigint size,
             xor(list_reduce(list_transform(range(0, octet_length(encode(t))), lambda j: ('0x' || substr(hx, (2 * j + 1)::bigint, 2))::bigint),
                 lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1]), 4294967295::bigint), 4294967295::bigint) text_crc32
      from h, crc),
n as (select count(*)::bigint n from documents),
dom as (select n, (floor(sqrt(greatest(n - 1, 0)))::bigint + 1) a from n),
dm as (select n, a, ((n + a - 1) // a)::bigint b from dom),
num as (select *, row_number() over (order by doc_id nulls first, text_crc32, size) - 1 rn from d),
walk(rn, x, steps) as (
  select rn::bigint, rn::bigint, 0 from num
  union all
  select rn, {result}, steps + 1 from (select w.rn, w.steps, a, b, {items} from walk w, dm where w.steps = 0 or w.x >= n) z)
select doc_id, size, text_crc32, 'rows' law, (x % {SHARDS})::int shard, (x // {SHARDS})::bigint slot, null::int grown_shard
from num join (select rn, arg_max(x, steps) x from walk group by rn) using (rn)
"""


ORACLE = _sql()
