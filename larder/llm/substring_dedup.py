"""Removal of repeated word windows by Rabin-Karp hashes.

A window is ``window`` consecutive words. Windows that start earlier elsewhere (smaller id, or earlier in the
same document) are repeated; the words they cover go, as maximal intervals. First, documents equal to one with
a smaller id are set aside: all their windows are repeated. In the others every window gets its rolling hash.

Most windows occur once, and a shuffle of all hashes would be larger than the texts. So each window first names an
anchor, the least hash among the runs of ``run`` words inside it; equal windows name equal anchors, and
neighbouring windows mostly share theirs. Anchors are dealt to buckets by their hash, and the places of those
that occur more than once go back to their documents. Only windows with such an anchor can be repeated; their
hashes are dealt to buckets in turn, together with a second hash under another base, and all but the first place of
each are removed. Rows of one anchor or window hash go on as one from each task, so frequent passages stay
small. Windows are judged on the input, not on what is left.

What goes back to a document are spans, not places, so a passage is two numbers. These tables are joined with a broadcast while they take less than
``broadcast_bytes``, and with a shuffle of the texts beyond that.

Defined results: a null or empty text has no words. A null id comes before all others. Equal rows (id and text)
are one document and share the result; rows of one id with different texts are ordered by a hash of the text. An
empty table gives an empty result. Further columns are ignored. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.arrays import U, Words, by_bucket, mixed, pieces, planes, runs, unplaned
from larder.llm.common import WORD, prepare, table
from larder.session import staged

NULL_ID = -(1 << 63)
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
DEALT = "kind int, bucket int, id bigint, tag int, at binary, keys binary, more binary, ids binary, places binary"
PLACES = "id bigint, tag int, at binary"
TAG = 1 << 16  # values of the text hash that tell rows of one id apart


class Rolling:
    """Hashes of all runs of a number of words, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.powers, self.inverses = base, np.ones(1, U), np.ones(1, U)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            inverse = pow(self.base, -1, 1 << 64)
            self.powers = np.cumprod(np.concatenate([np.ones(1, U), np.full(n, self.base, U)]))
            self.inverses = np.cumprod(np.concatenate([np.ones(1, U), np.full(n, inverse, U)]))

    def __call__(self, hashes: np.ndarray, width: int) -> np.ndarray:
        n = len(hashes)
        self._grow(n + 1)
        total = np.concatenate([np.zeros(1, U), np.cumsum(hashes * self.powers[:n])])
        return mixed((total[width:] - total[:-width]) * self.inverses[: n + 1 - width])


class Windows:
    """Words, windows and anchors of a piece of rows."""

    def __init__(self, window: int, run: int):
        self.window, self.run, self.words = window, run, Words()
        self.rolling = [Rolling(b) for b in BASES]

    def load(self, piece: pa.RecordBatch) -> bool:
        self.words.renew()
        lists = [(t or b"").split() for t in piece.column("text").to_pylist()]
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        numbers = np.concatenate([self.words.numbers(x) for x in lists])
        self.hashes = self.words.hashes(numbers) if len(numbers) else np.empty(0, U)
        if not (self.sizes >= self.window).any():
            return False
        row = np.repeat(np.arange(len(lists)), self.sizes)
        starts = np.arange(max(0, len(numbers) - self.window + 1))
        inside = starts + self.window <= (self.first + self.sizes)[row[: len(starts)]]
        self.starts = starts[inside]
        self.row = row
        return True

    def anchors(self) -> np.ndarray:
        """Place of each window's anchor; the leftmost of equal ones."""
        g = self.rolling[0](self.hashes, self.run)
        room = self.window - self.run + 1
        least, span = g, 1
        while span < room:
            step = min(span, room - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        low = least[self.starts]
        place = np.full(len(self.starts), -1, np.int64)
        for o in range(room - 1, -1, -1):
            same = g[self.starts + o] == low
            place[same] = self.starts[same] + o
        self.g = g
        return place

    def local(self, places: np.ndarray) -> np.ndarray:
        return places - self.first[self.row[places]]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5)
    names = ["kind", "bucket", "id", "tag", "at", "keys", "more", "ids", "places"]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _by_document(ids: np.ndarray, tags: np.ndarray, at: np.ndarray) -> list[tuple[int, int, bytes]]:
    """``(id, tag, sorted places)`` of each document."""
    order = np.lexsort((at, tags, ids))
    ids, tags, at = ids[order], tags[order], at[order].astype("<i4")
    edges = np.unique(np.concatenate([runs(ids), runs(tags)])) if len(ids) else [0]
    return [(int(ids[a]), int(tags[a]), at[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]


def _deal(window: int, run: int, buckets: int, anchored: bool):
    """First round: places of anchors. Second (``anchored``): windows whose anchor is marked."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view = Windows(window, run)
        for piece in pieces(batches, "text"):
            if not view.load(piece):
                continue
            ids = np.asarray(piece.column("id"), np.int64)
            tags = np.asarray(piece.column("tag"), np.int64)
            anchors = view.anchors()
            if anchored:
                marked = np.zeros(len(view.hashes), bool)
                for k, packed in enumerate(piece.column("spans").to_pylist()):
                    for a, b in _unpacked(packed).tolist():
                        marked[view.first[k] + a : view.first[k] + b + 1] = True
                at = view.starts[marked[anchors]]
                keys, more = view.rolling[0](view.hashes, window)[at], view.rolling[1](view.hashes, window)[at]
            else:
                at = np.unique(anchors)
                keys, more = view.g[at] >> U(16), None
            who, tag, place = ids[view.row[at]], tags[view.row[at]], view.local(at)
            order = np.lexsort((place, tag, who, keys))
            keys, who, tag, place = keys[order], who[order], tag[order], place[order]
            more = more[order] if anchored else None
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            if anchored:
                new[1:] |= more[1:] != more[:-1]
                gone = ~new
            else:
                edges = np.append(np.flatnonzero(new), len(keys))
                gone = np.repeat(np.diff(edges) > 1, np.diff(edges))
            rows = [(0, i % buckets, i, t, x, None, None, None, None) for i, t, x in _by_document(who[gone], tag[gone], place[gone])]
            keys, who, place = keys[new], who[new], (place + tag * (1 << 40))[new]
            more = more[new] >> U(32) if anchored else None
            order, parts = by_bucket(keys, buckets)
            keys, who, place = keys[order] // U(buckets), who[order].view(U), place[order].view(U)
            more = more[order] if anchored else None
            rows += [(1, b, None, None, None, planes(keys[x:y]), planes(more[x:y]) if anchored else None, planes(who[x:y]), planes(place[x:y])) for b, x, y in parts]
            yield _batch(rows)

    return deal


def _resolve(anchored: bool):
    """Of each bucket the places of keys that occur more than once; in the second round without the first place."""

    def one(blobs: list[tuple]) -> pa.RecordBatch:
        keys, who, place = (np.concatenate([unplaned(x[k]) for x in blobs]) for k in (0, 2, 3))
        who, place = who.view(np.int64), place.view(np.int64)
        more = np.concatenate([unplaned(x[1]) for x in blobs]) if anchored else np.zeros(len(keys), U)
        order = np.lexsort((place, who, more, keys))
        keys, more, who, place = keys[order], more[order], who[order], place[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])
        if anchored:
            out = ~new
        else:
            edges = np.append(np.flatnonzero(new), len(keys))
            out = np.repeat(np.diff(edges) > 1, np.diff(edges))
        docs = _by_document(who[out], place[out] >> 40, place[out] & ((1 << 40) - 1))
        columns = zip(*docs) if docs else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()))], names=["id", "tag", "at"])

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for batch in batches:
            plain = batch.filter(pc.equal(batch.column("kind"), 0))
            if plain.num_rows:
                yield plain.select(["id", "tag", "at"])
            rest = batch.filter(pc.equal(batch.column("kind"), 1))
            for b, *x in zip(*(rest.column(c).to_pylist() for c in ("bucket", "keys", "more", "ids", "places"))):
                if b != now and blobs:
                    yield one(blobs)
                    blobs = []
                now = b
                blobs.append(x)
        if blobs:
            yield one(blobs)

    return resolve


def _spans(gap: int):
    """One list of spans ``start, end`` (inclusive) per document from its lists of places at most ``gap`` apart."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for lists in batch.column("marks").to_pylist():
                at = np.unique(np.concatenate([np.frombuffer(x, "<i4") for x in lists]))
                cut = np.flatnonzero(np.diff(at) > gap)
                made.append(np.stack([at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]], axis=1).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tag"), pa.array(made, pa.binary())], names=["id", "tag", "spans"])

    return spans


def _unpacked(spans: bytes | None) -> np.ndarray:
    return np.frombuffer(spans or b"", "<i4").reshape(-1, 2)


def _cut(window: int):
    """Texts without the words of repeated windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            n, removed, kept, spans = [], [], [], []
            columns = (piece.column(c).to_pylist() for c in ("text", "copy", "spans"))
            for text, copy, packed in zip(*columns):
                words = (text or b"").split()
                out = np.zeros(len(words) + 1, np.int64)
                if copy and len(words) >= window:
                    out[0], out[-1] = 1, -1
                at = _unpacked(packed)
                np.add.at(out, at[:, 0], 1)
                np.add.at(out, at[:, 1] + window, -1)
                gone = np.cumsum(out)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                n.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(words if not removed[-1] else [w for w, g in zip(words, gone.tolist()) if not g]).decode("utf-8", "replace"))
                spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, span)],
                names=["id", "n_words", "n_removed", "text", "removed"],
            )

    return cut


def _sent(df: DataFrame, size, most: int) -> DataFrame:
    """``df`` with a broadcast hint if its rows take at most ``most`` bytes."""
    bytes_ = df.agg(F.sum(size + 64)).first()[0] or 0
    return F.broadcast(df) if bytes_ <= most else df


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, run: int = 8, broadcast_bytes: int = 96 << 20
) -> DataFrame:
    """``(id, n_words, n_removed, text, removed)``: the kept words, and the removed word intervals ``[start, end)``."""
    spark = docs.sparkSession
    prepare(spark)
    deals = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(256, 4 * deals)
    run = min(run, window)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("id"), F.pmod(F.xxhash64(text), F.lit(TAG)).cast("int").alias("tag"),
        text.cast("binary").alias("text"),
    )
    names = rows.select("id", "tag", F.unhex(F.md5("text")).alias("m"))
    firsts = names.groupBy("m").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    equal = names.join(firsts.select("m", "first"), "m").groupBy("id", "tag")
    equal = staged(equal.agg(F.bool_or(F.col("id") > F.col("first")).alias("later"), F.count(F.lit(1)).alias("rows")), "equal-texts")
    copies = _sent(equal.filter("later").select("id", "tag"), F.lit(0), broadcast_bytes)
    base = rows.join(copies, ["id", "tag"], "left_anti").select("id", "tag", "text")
    again = equal.filter("NOT later AND rows > 1").select("id", "tag")
    if again.limit(1).count():
        # Equal rows are one document, or each would be a repetition of the other.
        again = _sent(again, F.lit(0), broadcast_bytes)
        once = base.join(again, ["id", "tag"], "left_semi").distinct()
        base = base.join(again, ["id", "tag"], "left_anti").unionByName(once)

    def places(frame: DataFrame, anchored: bool, name: str) -> DataFrame:
        dealt = frame.mapInArrow(_deal(window, run, buckets, anchored), DEALT)
        dealt = dealt.repartition(deals, "bucket").sortWithinPartitions("kind", "bucket")
        found = dealt.mapInArrow(_resolve(anchored), PLACES)
        lists = found.groupBy("id", "tag").agg(F.collect_list("at").alias("marks"))
        # Anchors of neighbouring windows lie no farther apart than this; what lies between is checked as well.
        spans = lists.mapInArrow(_spans(1 if anchored else window - run + 1), "id bigint, tag int, spans binary")
        return _sent(staged(spans, name), F.octet_length("spans"), broadcast_bytes)

    anchors = places(base, False, "repeated-anchors")
    gone = places(base.join(anchors, ["id", "tag"]).select("id", "tag", "text", "spans"), True, "repeated-windows")
    marked = rows.join(gone, ["id", "tag"], "left").join(copies.withColumn("copy", F.lit(True)), ["id", "tag"], "left")
    out = "id bigint, n_words bigint, n_removed bigint, text string, removed array<struct<start:bigint,end:bigint>>"
    kept = marked.select("id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "spans").mapInArrow(_cut(window), out)
    return kept.withColumn("id", F.nullif(F.col("id"), F.lit(NULL_ID)))


def op2_substring_dedup(spark, folder):
    rows = substring_dedup(table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op2_substring_dedup": op2_substring_dedup}
SQL = {
    "op2_substring_dedup": rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM s),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM h) WHERE n > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r)
SELECT d.doc_id, len(w)::BIGINT AS n_words, count(g.i)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(p.word, ' ' ORDER BY p.i) FILTER (p.i IS NOT NULL AND g.i IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY d.doc_id, w"""
}
