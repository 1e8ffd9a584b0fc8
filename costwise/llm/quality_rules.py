"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

``signals`` computes word and line statistics of whole texts. ``certify`` takes labelled
documents and picks, for each stratum (language) and rule, the strictest cutoff of a fixed
grid whose rate of rejecting good documents is proven low: cutoffs are tested from lenient
to strict with the exact binomial tail P(Bin(n, alpha) <= k) and the sequence stops at the
first one that is not significant (fixed-sequence testing needs no correction); strata and
rules share ``delta`` by Bonferroni, and the rules share the risk ``alpha``. So with
probability 1 - delta no stratum loses more than ``alpha`` of its good documents to the rules.
The grid is fixed beforehand and no rule is fitted, so all labelled rows serve as holdout.

Edge cases: a null or empty text has no words and fails the base rules; a null language is
the stratum ``(none)``; a stratum without labels, or with too few, gets no cutoff and rejects
nothing; repeated label rows count once for each pair; no labels at all: nothing is rejected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import documents, materialize, read

WORD = r"[^\x20\x09-\x0D]"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Rule: (ratio column, cutoffs from lenient to strict); a text is rejected at or above the cutoff.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_ratio": (4.0, 2.0, 1.0, 0.5, 0.25, 0.1),
    "dup_line_ratio": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),
    "repeat_ratio": (0.18, 0.15, 0.12, 0.1, 0.05),
    "word_length": (14.0, 12.0, 10.0, 9.0, 8.0),
}
ALPHA, DELTA = 0.05, 0.05
TERMS = 1000


def _count(text: str, chars: str) -> Column:
    """Occurrences of any of the (single-byte) characters."""
    total = F.lit(0).cast("long")
    for c in chars:
        total = total + F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit(c), F.lit("")))
    return total


def signals(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed.
    Windows of five words are compared by a 64-bit hash of their words."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = (df.withColumn("_t", t)
           .withColumn("_w", F.filter(F.split("_t", GAP), lambda w: w != ""))
           .withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)))
           .withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w))))
    h = F.col("_h")
    near = lambda i: [F.get(h, i + k) for k in range(1, 5)]
    out = (out.withColumn("_g", F.when(F.size(h) >= 5, F.transform(
        F.slice(h, F.lit(1), F.size(h) - 4), lambda x, i: F.xxhash64(x, *near(i))))
        .otherwise(F.array().cast("array<bigint>"))))
    again = F.size(F.array_distinct("_g")) < F.size("_g")
    out = out.withColumn("_p", F.when(again, F.sort_array(F.transform(
        "_g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    p = F.col("_p")
    twice = F.filter(p, lambda x, i: (x["h"] == F.get(p, i + 1)["h"]) | ((i > 0) & (x["h"] == F.get(p, i - 1)["h"])))
    out = out.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    at = F.col("_at")
    covered = F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(5), F.coalesce(F.get(at, i + 1) - x, F.lit(5)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    out = (out.withColumn("n_words", F.size("_w").cast("long"))
           .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
           .withColumn("n_symbols", _count("_t", SYMBOLS))
           .withColumn("n_lines", F.size("_l").cast("long"))
           .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
           .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))))
    return (out.withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))
            .drop("_t", "_w", "_l", "_h", "_g", "_p", "_at"))


def ratios(df: DataFrame) -> DataFrame:
    n = F.greatest("n_words", F.lit(1)).cast("double")
    return (df.withColumn("symbol_ratio", F.col("n_symbols") / n)
            .withColumn("dup_line_ratio", F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)).cast("double"))
            .withColumn("repeat_ratio", F.col("n_repeat_words") / n)
            .withColumn("word_length", F.col("word_chars") / n))


def log_factorial(n: Column) -> Column:
    x = n.cast("double")
    far = (x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2 + 1 / (x * 12) - 1 / (F.pow(x, 3) * 360)
           + 1 / (F.pow(x, 5) * 1260))
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(far)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k below the mean, else 1. The terms fall at least geometrically
    below k; past ``TERMS`` of them a geometric bound of the rest is added, so the value is
    exact or slightly too large, never too small."""
    odds = (1 - p) / p
    log_top = (log_factorial(n) - log_factorial(k) - log_factorial(n - k)
               + k * math.log(p) + (n - k) * math.log1p(-p))
    start = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"), k.cast("double").alias("i"))

    def add(acc, _):
        ratio = acc["i"] * odds / (n - acc["i"] + 1)
        return F.struct((acc["sum"] + acc["term"] * ratio).alias("sum"), (acc["term"] * ratio).alias("term"),
                        F.greatest(acc["i"] - 1, F.lit(0.0)).alias("i"))

    def close(acc):
        ratio = acc["i"] * odds / (n - acc["i"] + 1)
        return acc["sum"] + acc["term"] * ratio / (1 - ratio)

    total = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, add, close)
    return F.when(k.cast("double") < n * p, F.exp(log_top) * total).otherwise(F.lit(1.0))


def certify(good: DataFrame, stratum: str, rules: dict[str, tuple[float, ...]] | None = None,
            alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum of the good documents: n and, per rule, the certified cutoff or null."""
    rules = rules or RULES
    each = alpha / len(rules)
    hits = [F.sum((F.col(r) >= c).cast("long")).alias(f"{r}_{j}") for r, cs in rules.items() for j, c in enumerate(cs)]
    counts = good.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"), *hits)
    tests = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(j).alias("level"), F.lit(float(c)).alias("cutoff"),
                               F.col(f"{r}_{j}").alias("k")) for r, cs in rules.items() for j, c in enumerate(cs)])
    rows = counts.select(stratum, "n", F.explode(tests).alias("x")).select(stratum, "n", "x.*")
    # the counts are a row per stratum and test: nothing here grows with the documents
    strata = counts.agg(F.count(F.lit(1)).alias("_strata"))
    rows = rows.crossJoin(F.broadcast(strata)).withColumn("p", binomial_tail(F.col("n"), F.col("k"), each))
    ok = F.col("p") <= F.lit(delta) / (F.col("_strata") * len(rules))
    w = Window.partitionBy(stratum, "rule").orderBy("level")
    rows = rows.withColumn("_ok", F.min(ok.cast("int")).over(w))
    return rows.groupBy(stratum).agg(F.max("n").alias("n"), *[
        F.min(F.when((F.col("rule") == r) & (F.col("_ok") == 1), F.col("cutoff"))).alias(f"cut_{r}") for r in rules])


def apply_rules(df: DataFrame, cutoffs: DataFrame, stratum: str,
                rules: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """Adds rejected: some rule's value reaches its stratum's cutoff."""
    rules = rules or RULES
    fired = [F.coalesce(F.col(r) >= F.col(f"cut_{r}"), F.lit(False)) for r in rules]
    any_fired = fired[0]
    for f in fired[1:]:
        any_fired = any_fired | f
    return (df.join(cutoffs.drop("n"), stratum, "left").withColumn("rejected", any_fired)
            .drop(*[f"cut_{r}" for r in rules]))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.coalesce("lang", F.lit("(none)")).alias("stratum"))
    sig = ratios(materialize(signals(docs).drop("text"), "quality-signals"))
    good = (read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
            .join(sig.filter(~F.col("base_failed")), "doc_id"))
    cutoffs = materialize(certify(good, "stratum"), "quality-cutoffs")
    return apply_rules(sig, cutoffs, "stratum").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("rejected")).alias("kept"))


def _sql() -> str:
    each, ratios_sql = ALPHA / len(RULES), {
        "symbol_ratio": "n_symbols / greatest(n_words, 1)::double",
        "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)::double",
        "repeat_ratio": "n_repeat_words / greatest(n_words, 1)::double",
        "word_length": "word_chars / greatest(n_words, 1)::double"}
    grid = ", ".join(f"('{r}', {j}, {c}::double)" for r, cs in RULES.items() for j, c in enumerate(cs))
    value = " ".join(f"when '{r}' then {r}" for r in RULES)
    return rf"""
with w as (select doc_id, coalesce(lang, '(none)') stratum,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls,
                  length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) n_symbols from documents),
u as (select doc_id, unnest(range(1, len(ws) + 1)) i, unnest(ws) x from w where len(ws) >= 5),
g as (select doc_id, i, x || ' ' || lead(x, 1) over o || ' ' || lead(x, 2) over o || ' ' || lead(x, 3) over o || ' ' || lead(x, 4) over o f
      from u window o as (partition by doc_id order by i)),
gg as (select doc_id, i, count(*) over (partition by doc_id, f) c from g where f is not null),
cov as (select doc_id, count(distinct i + o) n from gg, range(5) t(o) where c > 1 group by doc_id),
b as (select doc_id, stratum, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars,
             n_symbols::bigint n_symbols, len(ls) n_lines, (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines,
             coalesce(n, 0)::bigint n_repeat_words from w left join cov using (doc_id)),
s as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
             {', '.join(f'{v} {k}' for k, v in ratios_sql.items())} from b),
grid(rule, level, cutoff) as (values {grid}),
good as (select s.* from s join labels l using (doc_id) where l.quality = 1 and not base_failed),
cnt as (select stratum, rule, level, any_value(cutoff) cutoff, count(*) n,
               sum((case rule {value} end >= cutoff)::int) k from good, grid group by stratum, rule, level),
tail as (select stratum, rule, level, any_value(cutoff) cutoff, any_value(n) n, any_value(k) k,
                sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({each}) + (n - i) * ln({1 - each}))) p
         from (select *, unnest(range(0, k::bigint + 1)) i from cnt) group by stratum, rule, level),
bad as (select t.stratum, t.rule, min(t.level) filter (where p > {DELTA} / (z.n_strata * {len(RULES)})) first_bad
        from tail t, (select count(distinct stratum) n_strata from cnt) z group by t.stratum, t.rule),
cut as (select t.stratum, t.rule, min(t.cutoff) cutoff from tail t join bad using (stratum, rule)
        where first_bad is null or t.level < first_bad group by t.stratum, t.rule),
hit as (select distinct s.doc_id from s join cut using (stratum) where case cut.rule {value} end >= cut.cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and h.doc_id is null kept
from s left join hit h using (doc_id)
"""


ORACLE = _sql()
