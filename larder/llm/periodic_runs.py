"""Periodic runs of words by Lyndon roots.

A run is a stretch of words with smallest period q, at least ``exponent`` periods long, that no neighbouring word extends. Every run
holds a Lyndon word of length q that is the longest one at its place, under the given order of the words or under the reversed one. So
three steps find all runs of a text:

* Phase one of Baier's suffix sorter groups the places of a text by their longest Lyndon word, under both orders. The groups start as the
  words; from the highest down, each group lengthens the places before its members, which move to new groups right above their old
  ones. The lengths of the groups are the Lyndon arrays; nothing is sorted beyond that.
* Each place with its Lyndon length is a root, extended to both sides as far as words one period apart agree. Stretches already found
  with that period are not extended again.
* Stretches of enough periods are the runs; both orders and all roots of a run give the same one.

A word that stands fewer than ``exponent`` times between two others of that kind cannot be in a run. Such words cut the text into
segments, again and again until none is left; this is exact, vectorised over a batch, and leaves the grouping the repetitive parts of the
texts only. Row by row, whole texts, no shuffle; a very long text needs a few dozen bytes a word in one task.

Defined results: a null text has no words, no runs and an empty collapsed text. Equal rows have equal results; ids may be null. An empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.arrays import Words, pieces
from larder.llm.common import WORD, col, prepare, table

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon_array(text: np.ndarray, reverse: bool = False) -> np.ndarray:
    """Length of the longest Lyndon word at each place, shorter prefixes being smaller; ``reverse`` turns the order of the letters."""
    n = len(text)
    letters, group = np.unique(-text if reverse else text, return_inverse=True)
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(len(letters) + 1)).tolist()
    order = order.tolist()
    members = [order[a:b] for a, b in zip(edges, edges[1:])]
    size, below = [1] * len(members), list(range(-1, len(members) - 1))
    above = list(range(1, len(members))) + [-1]
    at = [*group.tolist(), -1]  # group of each place; the end belongs to none
    left, right = list(range(-1, n)), list(range(1, n + 2))  # neighbours among the places not grouped for good
    now = len(members) - 1
    while now >= 0:
        longer: dict[tuple[int, int], list[int]] = {}
        passed = -1
        for i in members[now]:
            if at[i] != now or i <= passed:
                continue
            count, passed, after = 1, i, right[i]
            while at[after] == now:
                count, passed, after = count + 1, after, right[after]
            before = left[i]
            left[after] = before
            if before >= 0:
                right[before] = after
                key = (count, at[before])
                if key in longer:
                    longer[key].append(before)
                else:
                    longer[key] = [before]
        for count, old in sorted(longer, reverse=True) if len(longer) > 1 else longer:
            new, over = len(size), above[old]
            size.append(size[old] + count * size[now])
            below.append(old)
            above.append(over)
            above[old] = new
            below[over] = new  # a group is lengthened by higher ones only, so there is one above it
            places = longer[count, old]
            members.append(places)
            for i in places:
                at[i] = new
        members[now] = ()
        now = below[now]
    return np.array(size, np.int64)[at[:-1]]


def common(text: np.ndarray, a: int, b: int, step: int) -> int:
    """Number of equal words from the places ``a < b`` on, forwards or backwards."""
    most = len(text) - b if step > 0 else a + 1
    done, width = 0, 16
    while done < most:
        width = min(width, most - done)
        if step > 0:
            same = text[a + done : a + done + width] == text[b + done : b + done + width]
        else:
            same = (text[a - done - width + 1 : a - done + 1] == text[b - done - width + 1 : b - done + 1])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done, width = done + width, width * 2
    return done


def runs(text: np.ndarray, exponent: int = 2, shortest: int = 2) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of at least ``exponent`` (two or more) periods and ``shortest`` words."""
    found, ended = set(), {}
    for reverse in (False, True):
        root = lyndon_array(text, reverse)
        ended.clear()
        starts = np.arange(len(text))
        inside = starts + root < len(text)
        near = inside.copy()
        near[inside] = text[starts[inside]] == text[starts[inside] + root[inside]]
        near[1:] |= text[:-1] == text[starts[1:] + root[1:] - 1]
        for i, p in zip(starts[near].tolist(), root[near].tolist()):
            if i + p <= ended.get(p, 0):
                continue  # the same stretch of that period
            back, on = common(text, i - 1, i + p - 1, -1) if i else 0, common(text, i, i + p, 1)
            ended[p] = i + p + on
            length = back + p + on
            if length >= max(2, exponent) * p and length >= shortest:
                found.add((i - back, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(words: np.ndarray, rows: np.ndarray, least: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments ``(start, end)`` of the joined rows in which every word stands at least ``least`` times.

    ``rows`` is the row of each word. Words that are too rare end a segment; the rest is counted again until nothing changes.
    """
    at, segment = np.arange(len(words)), rows
    while True:
        key = segment.astype(np.int64) << 32 | words[at]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(key) else np.empty(0, np.int64)
        counts = np.diff(np.append(first, len(key)))
        kept = np.empty(len(key), bool)
        kept[order] = np.repeat(counts >= least, counts)
        stay, segment = at[kept], segment[kept]
        new = np.ones(len(stay), bool)
        new[1:] = (stay[1:] != stay[:-1] + 1) | (segment[1:] != segment[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(stay)))
        wide = sizes >= shortest
        done = kept.all() and wide.all()
        whole = np.repeat(wide, sizes)
        at, segment = stay[whole], np.repeat(np.arange(len(sizes)), sizes)[whole]
        if done:
            return at[starts], at[starts] + sizes


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without those that lie behind the first period of a run."""
    if not found:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def _find(exponent: int, shortest: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Words()
        for piece in pieces(batches, "text"):
            numbers.renew()
            texts = [(t or b"").split() for t in piece.column("text").to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            words = np.concatenate([numbers.numbers(t) for t in texts])
            ends = np.cumsum(sizes)
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for a, b in zip(*repetitive(words, np.repeat(np.arange(len(texts)), sizes), exponent, max(shortest, exponent))):
                row = int(np.searchsorted(ends, a, side="right"))
                begin = int(a - (ends[row] - sizes[row]))
                found[row] += [(begin + s, n, p) for s, n, p in runs(words[a:b], exponent, shortest)]
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            listed = [[dict(zip(("start", "length", "period"), r)) for r in f] for f in found]
            kept = [collapsed(w, f).decode("utf-8", "replace") for w, f in zip(texts, found)]
            columns = [piece.column("id"), pa.array(sizes), pa.array(listed, kind), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "runs", "collapsed"])

    return find


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = 4, shortest: int = 6) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` of every row: its runs by start and period, and its words without the repeats, joined by blanks."""
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_find(exponent, shortest), f"id {kind}, n_words bigint, runs {RUNS}, collapsed string")


def with_cycles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, text_col)`` as the contract changes them: in every tenth document by hash the words from a place on become a cycle."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    some = docs.select(F.col(id_col), F.col(text_col), F.when(h % 10 == 0, F.floor(h / 10)).cast("bigint").alias("_g"))
    some = some.withColumn("_w", F.when(F.col("_g").isNotNull(), F.regexp_extract_all(col(text_col), F.lit(WORD), F.lit(0))))
    some = some.withColumn("_n", F.when(F.col("_w").isNotNull(), F.size("_w")).cast("bigint"))
    some = some.withColumn("_a", F.when(F.col("_n") > 0, F.expr("_g % nullif(_n, 0)")))
    rest = F.col("_n") - F.col("_a")
    some = some.withColumn("_p", 1 + F.floor(rest / (3 + F.col("_g") % 8)))
    as_int = lambda c: c.cast("int")
    cycle = F.slice("_w", as_int(F.col("_a") + 1), as_int(F.col("_p")))
    tail = F.slice(F.flatten(F.array_repeat(cycle, as_int(F.ceil(rest / F.col("_p"))))), F.lit(1), as_int(rest))
    changed = F.array_join(F.concat(F.slice("_w", F.lit(1), as_int(F.col("_a"))), tail), " ")
    return some.select(id_col, F.when(F.col("_a").isNotNull(), changed).otherwise(F.col(text_col)).alias(text_col))


def longest(found: Column) -> Column:
    """The longest run, of equals the one with the smallest start and then period."""
    keyed = F.transform(found, lambda r: F.struct(-r["length"], r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(keyed)


def op12_periodic_runs(spark, folder):
    rows = periodic_runs(with_cycles(table(spark, folder, "documents"))).withColumn("_best", longest(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    length = -F.col("_best.col1")
    return rows.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), F.col("_best.start").alias("start"),
        length.alias("length"), F.col("_best.period").alias("period"),
        F.expr("(1000 * -_best.col1) div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
SQL = {
    # The CRC is folded bit by bit; a run is a maximal stretch of places whose words stand again one period later.
    "op12_periodic_runs": r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)) AS bytes
    FROM documents),
crc AS (SELECT rid, doc_id, w, len(w) AS n, xor(4294967295::BIGINT, list_reduce(bytes, lambda c, b: list_reduce(
    list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)))) AS h FROM docs),
cut AS (SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM crc),
made AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM cut),
pos AS (SELECT rid, n, unnest(w) AS word, unnest(range(n)) AS i FROM made),
pairs AS (SELECT x.rid, y.i - x.i AS q, x.i FROM pos x JOIN pos y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (SELECT rid, q, min(i) AS s, count(*) + q AS l FROM
    (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs) GROUP BY rid, q, island HAVING count(*) >= 3 * q AND count(*) + q >= 6),
runs AS (SELECT rid, s, l, min(q) AS q FROM stretches GROUP BY rid, s, l),
told AS (SELECT rid, count(*) AS n_runs, min({'l': -l, 's': s, 'q': q}) AS best, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines
    FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT pos.rid, string_agg(word, ' ' ORDER BY pos.i) AS text FROM pos ANTI JOIN gone ON pos.rid = gone.rid AND pos.i = gone.i GROUP BY pos.rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.q AS period, 1000 * -best.l // best.q AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM made LEFT JOIN told USING (rid) LEFT JOIN kept USING (rid)""",
}
