"""Spelling variants: pairs of vocabulary words one edit apart, by finite-state composition.

The pairs of words at one inserted, deleted or replaced code point are the strings that the composition
acceptor . one-edit transducer . acceptor relates. The composition is never built whole: its start is dealt
into *initial states*, each of which fixes what two words share outside an open window of positions, and each
partition enumerates the accepted pairs of its initial states over a minimised acceptor of their words.

An edit of a pair (s of L code points, t of L or L + 1) has one place, the length of the common prefix, from 0 to L.
A window [lo, hi) of places is an initial state of class L for each (first lo code points, last L - hi code points):
words of L and of L + 1 code points with both in common meet there. The windows of a class split its places, so each
pair is found in one window, once. A window with more than ``GROUP_WORDS`` words is split in two halves, each with more
in common, until none is left: at one place a class has at most 90 short and 90**2 long words, so every group is bounded and
no pair is lost.

Rows: ``near_pairs`` gives both directions of each pair with the other word's count. ``variants`` gives one row a word.
Edge cases: null and empty texts have no words; a null id reads as the empty string; repeated rows count again; an empty
table gives no rows; other columns of the documents are not read, so no name clashes; long texts and long words are
read whole (no step is recursive in a word's length).
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import documents, materialize

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One occurrence in so many loses a code point (decided by a checksum of document and word).
DROP_EVERY = 199
MIN_CHARS, MIN_COUNT, FORM_RATIO = 6, 5, 5
#: Words of one initial state in one task; a state with more is split. Must exceed 90 + 90**2.
GROUP_WORDS = 20_000
#: Words of the initial states that share one acceptor.
CHUNK_WORDS = 20_000


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all documents: runs of letters, lower-cased in A-Z only, with one code point deleted where the
    checksum of ``<doc_id>:<run>`` says so; words of ``MIN_CHARS`` and ``MIN_COUNT`` at least."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    ascii_only = F.octet_length("run") == F.length("run")
    runs = runs.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % DROP_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.filter(F.length("word") >= MIN_CHARS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


# --- initial states --------------------------------------------------------------------------------------------------

def _state(rows: DataFrame) -> DataFrame:
    """Adds the initial state of (word, n, cls, lo, hi) as one string."""
    tail = F.greatest(F.col("cls") - F.col("hi"), F.lit(0))
    first = F.substring("word", F.lit(1), F.col("lo"))
    last = F.when(tail > 0, F.substring("word", F.length("word") - tail + 1, tail)).otherwise(F.lit(""))
    return rows.withColumn("state", F.concat_ws(" ", "cls", "lo", "hi", first, last))


def _halves(lo, hi, cls):
    mid = F.floor((lo + hi) / 2).cast("int")
    return F.array(F.struct(cls.alias("cls"), lo.alias("lo"), mid.alias("hi")),
                   F.struct(cls.alias("cls"), mid.alias("lo"), hi.alias("hi")))


def initial_states(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(state, cls, lo, hi, word, n) for each window of each class that a word takes part in; no state holds more than
    ``group_words`` words unless its window is a single place."""
    size = F.length("word")
    short = _halves(F.lit(0), size + 1, size)
    long = _halves(F.lit(0), size, size - 1)
    windows = F.explode(F.when(size > 1, F.concat(short, long)).otherwise(short)).alias("w")
    rows = _state(words.select("word", "n", windows).select("word", "n", "w.*"))
    done = []
    while True:
        rows = materialize(rows, "variant-states")
        large = materialize(rows.filter("hi - lo > 1").groupBy("state").agg(F.count(F.lit(1)).alias("words"))
                            .filter(F.col("words") > group_words).select("state"), "variant-large")
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, "state", "left_anti"))
        split = rows.join(large, "state", "left_semi").select(
            "word", "n", F.explode(_halves(F.col("lo"), F.col("hi"), F.col("cls"))).alias("w"))
        rows = _state(split.select("word", "n", "w.*"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


# --- acceptor and composition ----------------------------------------------------------------------------------------

class Acceptor:
    """Minimised acyclic acceptors with one shared register: two states are one if the same strings lead from
    them to an end. A string's rank among the strings of a state is its number in sorted order, so words are told by
    counting and no string is built."""

    def __init__(self):
        self.known, self.arcs, self.final, self.count = {}, [], [], []
        self.pairs = {}

    def _freeze(self, final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        state = self.known.get(key)
        if state is None:
            state = self.known[key] = len(self.arcs)
            self.arcs.append(dict(arcs))
            self.final.append(final)
            self.count.append(int(final) + sum(self.count[t] for _, t in arcs))
        return state

    def add(self, words: list[str]) -> int:
        """The start state of an acceptor of sorted distinct ``words``."""
        open_nodes, before = [[False, []]], ""
        for word in words:
            shared = len(os.path.commonprefix([before, word]))
            while len(open_nodes) - 1 > shared:
                node = open_nodes.pop()
                open_nodes[-1][1].append((before[len(open_nodes) - 1], self._freeze(*node)))
            open_nodes += [[False, []] for _ in range(len(word) - shared)]
            open_nodes[-1][0] = True
            before = word
        while len(open_nodes) > 1:
            node = open_nodes.pop()
            open_nodes[-1][1].append((before[len(open_nodes) - 1], self._freeze(*node)))
        return self._freeze(*open_nodes[0])

    def after(self, state: int) -> Iterator[tuple[str, int, int]]:
        """(symbol, next state, rank of its first string) of the arcs of ``state``."""
        rank = int(self.final[state])
        for symbol, target in self.arcs[state].items():
            yield symbol, target, rank
            rank += self.count[target]

    def common(self, p: int, q: int) -> list[tuple[int, int]]:
        """Ranks in ``p`` and in ``q`` of each string that both accept."""
        todo = [(p, q)]
        while todo:
            x, y = todo[-1]
            if (x, y) in self.pairs:
                todo.pop()
                continue
            if x == y:
                self.pairs[x, y] = [(i, i) for i in range(self.count[x])]
                continue
            right = {s: (t, r) for s, t, r in self.after(y)} if self.arcs[x] else {}
            steps = [(t, rank, *right[s]) for s, t, rank in self.after(x) if s in right]
            missing = [(a, b) for a, _, b, _ in steps if (a, b) not in self.pairs]
            if missing:
                todo += missing
                continue
            found = [(0, 0)] if self.final[x] and self.final[y] else []
            for a, i, b, j in steps:
                found += [(i + m, j + n) for m, n in self.pairs[a, b]]
            self.pairs[x, y] = found
        return self.pairs[p, q]

    def replaced(self, start: int, places: int) -> Iterator[tuple[int, int]]:
        """Ranks (first the lesser) of the strings of ``start`` that differ in one symbol, before ``places``."""
        todo = [(start, 0, 0)]
        while todo:
            p, base, depth = todo.pop()
            if depth >= places:
                continue
            arcs = list(self.after(p))
            for i, (_, a, ra) in enumerate(arcs):
                todo.append((a, base + ra, depth + 1))
                for _, b, rb in arcs[i + 1:]:
                    for m, n in self.common(a, b):
                        yield base + ra + m, base + rb + n

    def inserted(self, start: int, longer: int, places: int) -> Iterator[tuple[int, int]]:
        """Ranks of a string of ``start`` and of one of ``longer`` that has one symbol more, the first that differs,
        before ``places``."""
        todo = [(start, longer, 0, 0, 0)]
        while todo:
            p, q, i, j, depth = todo.pop()
            if depth >= places:
                continue
            here = {s: (t, r) for s, t, r in self.after(p)}
            for s, t, r in self.after(q):
                on = here.get(s)
                if on is None:
                    for m, n in self.common(p, t):
                        yield i + m, j + r + n
                else:
                    low, high = on[1], on[1] + self.count[on[0]]
                    for m, n in self.common(p, t):
                        if not low <= m < high:  # the next symbol would be s: the edit is further on
                            yield i + m, j + r + n
                    todo.append((on[0], t, i + on[1], j + r, depth + 1))


def _pairs_of(acceptor: Acceptor, words: list[str], cls: int, lo: int, hi: int) -> Iterator[tuple[str, str]]:
    """Pairs of one initial state: all of the class's length, or one of it and one longer."""
    tail = max(cls - hi, 0)
    inner = lambda w: w[lo:len(w) - tail]
    short = sorted(w for w in words if len(w) == cls)
    long = sorted(w for w in words if len(w) == cls + 1)
    if not short or len(short) + len(long) < 2:
        return
    start = acceptor.add([inner(w) for w in short])
    for i, j in acceptor.replaced(start, hi - lo):
        yield short[i], short[j]
    if long:
        for i, j in acceptor.inserted(start, acceptor.add([inner(w) for w in long]), hi - lo):
            yield short[i], long[j]


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of the pairs of all initial states; the rows come sorted by state."""
    acceptor, used, group, at = Acceptor(), 0, {}, None
    left, right, seen = [], [], []

    def flush() -> None:
        nonlocal acceptor, used
        if len(group) > 1:
            for a, b in _pairs_of(acceptor, list(group), *at[1:]):
                left.extend((a, b))
                right.extend((b, a))
                seen.extend((group[b], group[a]))
        used += len(group)
        if used > CHUNK_WORDS:
            acceptor, used = Acceptor(), 0
        group.clear()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string()),
                                            pa.array(seen, pa.int64())], names=["word", "near", "near_n"])
        for held in (left, right, seen):
            held.clear()
        return batch

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("state", "cls", "lo", "hi", "word", "n")]
        for state, cls, lo, hi, word, n in zip(*columns):
            if at is None or state != at[0]:
                if at is not None:
                    flush()
                    if len(left) > 50_000:
                        yield out()
                at = (state, cls, lo, hi)
            group[word] = n
    if at is not None:
        flush()
    yield out()


def near_pairs(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, near, near_n): both directions of each pair of ``words`` (word, n) one edit apart."""
    states = initial_states(words, group_words).select("state", "cls", "lo", "hi", "word", "n")
    return (states.repartition("state").sortWithinPartitions("state")
            .mapInArrow(_enumerate, "word string, near string, near_n long"))


# --- forms and roots -------------------------------------------------------------------------------------------------

def variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the vocabulary of ``docs`` (doc_id, text)."""
    words = materialize(vocabulary(docs), "variant-words")
    best = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    is_form = -F.col("best.m") >= FORM_RATIO * F.col("n")
    rows = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")),
        "variant-forms")
    top = words.agg(F.max("n")).first()[0] or 1
    # each step multiplies n by FORM_RATIO at least, so a chain has at most this many steps
    steps = max(math.log(max(top, 1), FORM_RATIO), 1)
    roots = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = materialize(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
                            "variant-roots")
    return rows.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir).select("doc_id", "text"))


_CRC = """
crc_table as (
  select list(v order by i) tab from (
    select i, list_reduce(range(0, 9), lambda c, k: case when k = 0 then c when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end,
                          i::bigint) v from range(256) t(i)))"""

#: The rule over sets: a replaced code point is a wildcard in equal patterns, a deleted one gives the shorter word.
ORACLE = f"""
with recursive {_CRC},
runs as (select coalesce(doc_id::varchar, '') id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') run
         from documents),
each as (select id, run, count(*) times, hex(encode(id || ':' || run)) hx from runs group by id, run),
sums as (select run, times, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(hx) // 2),
                 lambda j: ('0x' || substr(hx, (2 * j + 1)::bigint, 2))::bigint)),
                 lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295::bigint) h from each, crc_table),
heard as (select case when h % {DROP_EVERY} = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end word, times
          from sums),
v as (select word, sum(times)::bigint n from heard where length(word) >= {MIN_CHARS} group by word having sum(times) >= {MIN_COUNT}),
gap as (select word, n, p, substr(word, 1, p - 1) l, substr(word, p + 1) r from (select *, unnest(range(1, length(word) + 1)) p from v)),
near as (
  select a.word, b.word other from gap a join gap b on a.p = b.p and a.l = b.l and a.r = b.r and a.word <> b.word
  union select g.word, s.word from gap g join v s on s.word = g.l || g.r
  union select s.word, g.word from gap g join v s on s.word = g.l || g.r),
ranked as (select near.word, o.word form, o.n form_n, count(*) over (partition by near.word) n_near,
                  row_number() over (partition by near.word order by o.n desc, encode(o.word)) k
           from near join v o on o.word = near.other),
formed as (select v.word, v.n, coalesce(n_near, 0)::bigint n_near, case when form_n >= {FORM_RATIO} * v.n then form end form,
                  case when form_n >= {FORM_RATIO} * v.n then form_n end form_n
           from v left join ranked r on r.word = v.word and k = 1),
follow as (select word, word at_, 0 depth from formed
           union all select w.word, f.form, depth + 1 from follow w join formed f on f.word = w.at_ where f.form is not null)
select word, n, n_near, form, form_n, root from formed
join (select word, arg_max(at_, depth) root from follow group by word) using (word)
"""
