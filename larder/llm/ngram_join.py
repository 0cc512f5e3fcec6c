"""Exact Jaccard join of shingle sets by universe partition and the pigeonhole principle.

Sets fall into size bands whose bounds grow by 1 / threshold, so linked sets lie in one band or in neighbours.
In each band the universe of tokens is hashed into segments. Linked sets differ in at most H tokens; when the
segments get weights v (1: has to be equal, 2: may differ by one token) that add up to more than H, some
segment differs in fewer than v tokens. A set is indexed under its token subset of every segment, and for
weight 2 also under that subset's one-deletion neighbours. How many segments get weight 2 is chosen per band by a cost
model: entries written against candidates expected from keys of so many tokens. Segments without tokens say
nothing; spare weight makes up for as many of them as are likely, and a set with more is indexed again under
another seed (two linked sets meet at the first seed where either has enough; at the last seed empty segments
are indexed as well, so nothing is lost).

Keys are only filters: they are dealt to buckets, and documents that share a key are a group. The pairs of
groups of up to ``SMALL`` documents are candidates; larger groups are compared through their smallest member, then, where
members are still in different components, across those, in blocks of up to ``BLOCK`` members. Every candidate comes with a sketch
first, the number of its tokens in each of 64 to 2048 hashed bins: two sets differ in at least as many tokens as their sketches do,
so a pair whose sketches are too far apart cannot be linked and its texts are never read or shuffled. Pairs already in
one component need no comparison. A comparison of the pairs left intersects the whole sets. Documents with equal texts are linked with the smallest of
them and indexed once. A group that is large inside one task goes on as one row there, so a key that a third
of all documents share stays small in its bucket.

Defined results: texts without words, and null texts, have the empty set and link with nothing. Rows of one id
are one document with one set each, linked through the id. A null id has no component. An empty table gives an empty
result. Further columns are ignored. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.arrays import ODD, U, Words, by_bucket, mixed, pieces, planes, runs, unplaned
from larder.llm.common import LOWER, UPPER, WORD, prepare, table
from larder.llm.graph import components, few
from larder.session import staged

SEEDS = 12
SMALL = 4  # groups of so many documents are compared pair by pair, larger ones through their smallest member first
SIZE, MEMBER, PAIR, KEYS = range(4)
BLOCK = 1024  # members of a large group that meet as many others in one task
FEW = 64  # groups of up to so many members are met many at once
CELLS = 1 << 20  # differences of sketch bins held at once
SENT_SKETCHES, SENT_BYTES = 20_000, 32 << 20  # sketches, and bytes of texts, that are sent to the tasks instead of being dealt by id
WIDE_HOT, WIDE_RATE = 10.0, 0.3  # candidates expected from a key of no tokens, and the share left by each token
DEALT = "kind int, bucket int, id bigint, n bigint, keys binary, ids binary"
FOUND = "kind int, id bigint, n bigint"


class Partition:
    """Segments of each size band for one threshold (in percent)."""

    def __init__(self, percent: int):
        self.percent = percent
        bounds, low = [1], 1
        while low < 1 << 40:
            low = max(low + 1, -(-low * 100 // percent))
            bounds.append(low)
        self.bounds = np.array(bounds)

    def bands(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, sizes, side="right") - 1

    @lru_cache(maxsize=None)
    def plan(self, band: int) -> tuple[int, int, int]:
        """``(segments, doubled, spare)`` of a band: the first ``doubled`` segments have weight 2."""
        least, most = int(self.bounds[band]), int(self.bounds[band + 1]) - 1
        widest = most + most * 100 // self.percent
        differ = (100 - self.percent) * widest // (100 + self.percent)
        best = None
        for doubled in range((differ + 1) // 2 + 1):
            spare = 0
            for _ in range(4):
                m = max(1, differ + 1 + spare - doubled)
                empty = m * exp(-least / m) if m > 1 else 0.0
                spare = ceil(empty + 3 * sqrt(empty)) if empty > 0.01 else 0
            m = max(1, differ + 1 + spare - doubled)
            if doubled > m:
                continue
            width = least / m
            cost = (m - doubled) * (1 + WIDE_HOT * WIDE_RATE**width) + doubled * (1 + width) * (1 + WIDE_HOT * WIDE_RATE ** max(width - 1, 0))
            if best is None or cost < best[0]:
                best = (cost, m, doubled, spare)
            if doubled > 64 and cost > 2 * best[0]:
                break
        return best[1:]

    def keys(self, sets: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(keys, set number of each)`` of non-empty token sets."""
        bands, out_keys, out_docs = self.bands(sizes), [], []
        for shift in (0, 1):
            use = np.flatnonzero(bands >= shift)
            plans = [self.plan(int(b) - shift) for b in bands[use]]
            m = np.array([p[0] for p in plans], np.int64)
            doubled, spare = np.array([p[1] for p in plans], np.int64), np.array([p[2] for p in plans], np.int64)
            for seed in range(SEEDS):
                if not len(use):
                    break
                salt = np.full(1, seed + 1, U) * U(0x632BE59BD9B4E019) + (bands[use] - shift).astype(U) * ODD
                lengths = sizes[use]
                owner = np.repeat(np.arange(len(use)), lengths)
                tokens = np.concatenate([sets[i] for i in use])
                h = mixed(tokens ^ salt[owner])
                segment = ((h >> U(32)) * m[owner].astype(U) >> U(32)).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(m)[:-1]])
                slot = first[owner] + segment
                total = int(m.sum())
                value = mixed(tokens + ODD)
                sums, counts = np.zeros(total, U), np.bincount(slot, minlength=total)
                np.add.at(sums, slot, value)
                whose = np.repeat(np.arange(len(use)), m)
                number = np.arange(total) - first[whose]
                two = number < doubled[whose]
                salted = salt[whose] + number.astype(U) * U(0x2545F4914F6CDD1D)
                lost = np.bincount(whose, weights=(counts == 0) * np.where(two, 2, 1) + (two & (counts == 1)) * 2, minlength=len(use))
                last = seed == SEEDS - 1
                full = np.flatnonzero((counts > 0) | last)
                out_keys.append(mixed(sums[full] ^ salted[full]))
                out_docs.append(use[whose[full]])
                wide = np.flatnonzero(two[slot] & ((counts[slot] > 1) | last))
                out_keys.append(mixed((sums[slot[wide]] - value[wide]) ^ salted[slot[wide]]))
                out_docs.append(use[owner[wide]])
                again = lost > spare
                use, m, doubled, spare = use[again], m[again], doubled[again], spare[again]
        return np.concatenate(out_keys), np.concatenate(out_docs)


def shingles(words: Words, text: bytes | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text, lower-cased in A-Z."""
    parts = (text or b"").lower().split()
    if not parts:
        return np.empty(0, U)
    h = words.hashes(words.numbers(parts))
    width = min(width, len(h))
    out = h[: len(h) - width + 1].copy()
    for i in range(1, width):
        out = mixed(out) + h[i : len(h) - width + 1 + i]
    return np.unique(mixed(out + np.full(1, width, U) * ODD))


def _deal(percent: int, width: int, buckets: int, bits: int):
    """Set sizes, members of large groups inside a piece, and the keys for each bucket, as differences in their order."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, words = Partition(percent), Words()
        for piece in pieces(batches, "text"):
            ids, copies = piece.column("id").to_pylist(), piece.column("copy").to_pylist()
            words.renew()
            sets = [shingles(words, t, width) for t in piece.column("text").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            rows = [(SIZE, (i or 0) % buckets, i, n, None, None) for i, n in zip(ids, sizes.tolist())]
            use = [k for k, s in enumerate(sets) if len(s) and ids[k] is not None and not copies[k]]
            if use:
                keys, docs = partition.keys([sets[k] for k in use], sizes[use])
                keys, who = keys >> U(64 - bits), np.array([ids[k] for k in use], np.int64)[docs]
                keys, who = _distinct(keys, who)
                count = np.diff(runs(keys))
                large = np.repeat(count > SMALL, count)
                rows += [(MEMBER, g % buckets, i, g, None, None) for g, i in zip(keys[large].astype(np.int64).tolist(), who[large].tolist())]
                first = np.zeros(len(keys), bool)
                first[runs(keys)[:-1]] = True
                send = first | ~large
                keys, who, large = keys[send], who[send], large[send]
                order, parts = by_bucket(keys, buckets)
                keys, who = keys[order] // U(buckets) << U(1) | large[order].astype(U), who[order].view(U)
                rows += [(KEYS, b, None, None, planes(np.diff(keys[x:y], prepend=U(0))), planes(who[x:y])) for b, x, y in parts]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            names = ["kind", "bucket", "id", "n", "keys", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return deal


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct pairs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _rows(kind: int, ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids), pa.array(n)], names=["kind", "id", "n"])


def _groups(buckets: int):
    """Of each bucket: the pairs of small groups, the members of large ones; other rows pass."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, ids = None, [], []
        pairs: list[tuple[np.ndarray, np.ndarray]] = []

        def resolve() -> Iterator[pa.RecordBatch]:
            k, i = np.concatenate([np.cumsum(unplaned(x), dtype=U) for x in keys]), np.concatenate([unplaned(x) for x in ids]).view(np.int64)
            order = np.lexsort((i, k >> U(1)))
            k, i = k[order], i[order]
            flag, k = (k & U(1)).astype(bool), (k >> U(1)) * U(buckets) + U(now)
            edges = runs(k)
            count = np.diff(edges)
            large = (count > SMALL) | np.logical_or.reduceat(flag, edges[:-1])
            wide = np.repeat(large, count)
            if wide.any():
                yield _rows(MEMBER, i[wide], k[wide].astype(np.int64))
            k, i = k[~wide], i[~wide]
            for gap in range(1, SMALL):
                same = (k[gap:] == k[:-gap]) & (i[gap:] != i[:-gap])
                pairs.append((i[:-gap][same], i[gap:][same]))

        def flush() -> Iterator[pa.RecordBatch]:
            a, b = _distinct(*(np.concatenate(x) for x in zip(*pairs)))
            pairs.clear()
            yield _rows(PAIR, a, b)

        for batch in batches:
            plain = batch.filter(pc.less(batch.column("kind"), KEYS))
            if plain.num_rows:
                yield plain.select(["kind", "id", "n"])
            blobs = batch.filter(pc.equal(batch.column("kind"), KEYS))
            for b, k, i in zip(*(blobs.column(c).to_pylist() for c in ("bucket", "keys", "ids"))):
                if b != now and keys:
                    yield from resolve()
                    keys, ids = [], []
                    if sum(len(x) for x, _ in pairs) > 300_000:
                        yield from flush()
                now = b
                keys.append(k)
                ids.append(i)
        if keys:
            yield from resolve()
        if pairs:
            yield from flush()

    return groups


def _linked(percent: int, width: int):
    """Pairs whose sets meet the threshold; the set of a text is kept while it repeats."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last, x = Words(), None, None
        for batch in batches:
            words.renew()
            stay = np.zeros(batch.num_rows, bool)
            for k, (a, ta, tb) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "ta", "tb")))):
                if x is None or last != (a, ta):
                    last, x = (a, ta), shingles(words, ta, width)
                y = shingles(words, tb, width)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                stay[k] = len(x) and 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(stay))

    return linked


def _sketches(width: int):
    """Size and sketch of each text's set; counts stop at 255, which never makes a difference larger."""

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            words.renew()
            sizes, bins = [], []
            for text in batch.column("text").to_pylist():
                tokens = shingles(words, text, width)
                n = 1 << min(max(len(tokens).bit_length(), 6), 11)
                sizes.append(len(tokens))
                bins.append(np.minimum(np.bincount((tokens % U(n)).astype(np.int64), minlength=n), 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(bins, pa.binary())], names=["id", "n", "bins"])

    return sketches


def folded(bins: list[bytes], width: int) -> np.ndarray:
    """Sketches of any length as rows of ``width`` bins."""
    out = np.empty((len(bins), width), np.int32)
    for row, b in zip(out, bins):
        np.frombuffer(b, np.uint8).reshape(-1, width).sum(axis=0, out=row)
    return out


def near_pairs(percent: int, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, bins: list[bytes], left: np.ndarray, right: np.ndarray):
    """Pairs of a left and a right row with different labels whose sketches let them meet the threshold."""
    width = min(map(len, bins))
    table_ = folded(bins, width)
    step = max(1, CELLS // (width * len(right)))
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        apart = np.abs(table_[rows][:, None, :] - table_[right][None, :, :]).sum(axis=2)
        both = sizes[rows][:, None] + sizes[right][None, :]
        common = (both - apart) // 2
        x, y = np.nonzero((100 * common >= percent * (both - common)) & (labels[rows][:, None] != labels[right][None, :]))
        a, b = ids[rows[x]], ids[right[y]]
        yield np.minimum(a, b), np.maximum(a, b)


def may_link(percent: int, sizes: np.ndarray, bins: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of each pair of row numbers: whether sizes and sketches let it meet the threshold."""
    least, most = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
    out = 100 * least >= percent * most
    lengths = np.array([len(b) for b in bins], np.int64)
    narrow = np.minimum(lengths[left], lengths[right])
    for width in np.unique(narrow[out]).tolist():
        at = np.flatnonzero(out & (narrow == width))
        step = max(1, CELLS // (4 * width))
        for k in range(0, len(at), step):
            some = at[k : k + step]
            use, place = np.unique(np.concatenate([left[some], right[some]]), return_inverse=True)
            table_ = folded([bins[u] for u in use.tolist()], width)
            apart = np.abs(table_[place[: len(some)]] - table_[place[len(some) :]]).sum(axis=1)
            both = sizes[left[some]] + sizes[right[some]]
            common = (both - apart) // 2
            out[some] = 100 * common >= percent * (both - common)
    return out


def _close(percent: int):
    """Pairs whose sketches let them meet the threshold."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.arange(batch.num_rows)
            sizes = np.concatenate([np.asarray(batch.column(c)) for c in ("na", "nb")])
            bins = batch.column("ba").to_pylist() + batch.column("bb").to_pylist()
            yield batch.select(["a", "b"]).filter(pa.array(may_link(percent, sizes, bins, n, n + len(n))))

    return close


def _near(percent: int):
    """Of each block of a group: its pairs that may be linked. Rows come by group and block."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def block(rows: pa.Table) -> None:
            x, y, own = (np.asarray(rows.column(c)) for c in ("x", "y", "own"))
            ids, labels, sizes = (np.asarray(rows.column(c)) for c in ("id", "c", "n"))
            left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
            if not len(left) or not len(right):
                return
            bins = rows.column("bins").to_pylist()
            step = max(1, CELLS // len(right))
            for at in range(0, len(left), step):
                some = left[at : at + step]
                differ = labels[some][:, None] != labels[right][None, :]
                if 8 * np.count_nonzero(differ) > differ.size:
                    found.extend(near_pairs(percent, ids, labels, sizes, bins, some, right))
                    continue
                i, j = np.nonzero(differ)
                stay = may_link(percent, sizes, bins, some[i], right[j])
                a, b = ids[some[i[stay]]], ids[right[j[stay]]]
                found.append((np.minimum(a, b), np.maximum(a, b)))

        def small(rows: pa.RecordBatch, group: np.ndarray) -> None:
            """Groups of one block each, all in one go: rows that are 1, 2, ... places apart in one group."""
            ids, labels, sizes = (np.asarray(rows.column(c)) for c in ("id", "c", "n"))
            pairs = [(np.empty(0, np.int64),) * 2]
            for gap in range(1, FEW):
                same = group[gap:] == group[:-gap]
                if not same.any():
                    break
                left = np.flatnonzero(same & (labels[gap:] != labels[:-gap]))
                pairs.append((left, left + gap))
            left, right = (np.concatenate(v) for v in zip(*pairs))
            stay = may_link(percent, sizes, rows.column("bins").to_pylist(), left, right)
            a, b = ids[left[stay]], ids[right[stay]]
            found.append((np.minimum(a, b), np.maximum(a, b)))

        def flush() -> Iterator[pa.RecordBatch]:
            a, b = _distinct(*(np.concatenate(v) for v in zip(*found))) if found else (np.empty(0, np.int64),) * 2
            found.clear()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def key(batch: pa.RecordBatch, row: int) -> tuple:
            return tuple(batch.column(c)[row].as_py() for c in ("g", "x", "y"))

        for batch in batches:
            if not batch.num_rows:
                continue
            if held and key(held[-1], 0) != key(batch, 0):
                block(pa.Table.from_batches(held))
                held.clear()
            new = np.zeros(batch.num_rows, bool)
            for c in ("g", "x", "y"):
                v = np.asarray(batch.column(c))
                new[1:] |= v[1:] != v[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            whole = np.asarray(batch.column("blocks")) == 1
            few, number = np.zeros(batch.num_rows, bool), np.cumsum(new)
            for a, b in zip(cuts, cuts[1:]):
                if not held and b < batch.num_rows and b - a <= FEW and whole[a]:
                    few[a:b] = True
                    continue
                held.append(batch.slice(a, b - a))
                if b < batch.num_rows:
                    block(pa.Table.from_batches(held))
                    held.clear()
            if few.any():
                small(batch.filter(pa.array(few)), number[few])
            if sum(len(a) for a, _ in found) > 300_000:
                yield from flush()
        if held:
            block(pa.Table.from_batches(held))
        yield from flush()

    return near


def _sent(keys: DataFrame, most: int) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= most else keys


def similarity_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    broadcast_ids: int = 2_000_000,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, links)``: ``rows (id, n_shingles, component_id)`` of all documents, ``links (a, b)`` as verified.

    ``links`` holds links enough to connect every component, not each pair of a large group. Up to
    ``broadcast_ids`` ids (of copies, of candidates) are sent to the scan of the texts; more are joined with it.
    """
    spark = docs.sparkSession
    prepare(spark)
    deals = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(256, 4 * deals)
    # Keys as wide as keeps chance candidates rare at any size: one in 2**15 keys, whose number is about that of the bytes.
    size, n = docs.agg(F.sum(F.octet_length(text_col).cast("bigint")), F.count(F.lit(1))).first()
    bits = min(62, max(32, (size or 0).bit_length() + 14))
    plain = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.pmod(F.xxhash64(text_col), F.lit(1 << 16)).cast("int").alias("tag"),
        F.col(text_col).cast("binary").alias("text"), F.coalesce(F.col(text_col).rlike(WORD), F.lit(False)).alias("worded"),
    )
    names = plain.filter("worded AND id IS NOT NULL").select("id", "tag", F.unhex(F.md5("text")).alias("m"))
    firsts = names.groupBy("m").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("m", "first")
    firsts = _sent(staged(few(firsts, n), "repeated-texts"), broadcast_ids)  # sent, a text with many copies does not go to one task
    copies = staged(few(names.join(firsts, "m").filter("id > first").select("id", "tag", "first").distinct(), n), "equal-texts")
    marks = _sent(few(copies.select("id", "tag", F.lit(True).alias("copy")).distinct(), n), broadcast_ids)
    read = plain.join(marks, ["id", "tag"], "left").select("id", "text", F.coalesce("copy", F.lit(False)).alias("copy"))
    dealt = read.mapInArrow(_deal(percent, width, buckets, bits), DEALT).repartition(deals, "bucket").sortWithinPartitions("kind", "bucket")
    found = staged(dealt.mapInArrow(_groups(buckets), FOUND), "set-keys")
    sizes = found.filter(f"kind = {SIZE}").select("id", F.col("n").alias("n_shingles"))
    n_member, n_pair = found.agg(*[F.count_if(F.col("kind") == kind) for kind in (MEMBER, PAIR)]).first()
    members = staged(few(found.filter(f"kind = {MEMBER}").select(F.col("n").alias("g"), "id").distinct(), n_member), "members")

    hubs = _sent(staged(few(members.groupBy("g").agg(F.min("id").alias("a")), n_member), "hubs"), broadcast_ids)
    stars = members.join(hubs, "g").filter("a <> id").select("a", F.col("id").alias("b"))
    small = found.filter(f"kind = {PAIR}").select(F.col("id").alias("a"), F.col("n").alias("b"))
    met = staged(few(small.union(stars).distinct(), n_pair + n_member), "set-pairs")
    ids = met.select("a").union(met.select("b")).union(members.select("id")).distinct().withColumnRenamed("a", "cid")
    worded = plain.filter("worded").select("id", "text")
    ids = staged(few(ids, n), "candidates")
    inside = worded.join(_sent(ids, broadcast_ids), F.col("id") == F.col("cid"), "left_semi")
    sketches = inside.mapInArrow(_sketches(width), "id bigint, n bigint, bins binary").distinct()
    sketches = _sent(staged(few(sketches, ids.count(), 2048), "sketches"), SENT_SKETCHES)
    right = met.join(sketches.toDF("b", "nb", "bb"), "b")
    near = right.join(sketches.toDF("a", "na", "ba"), "a").select("a", "b", "na", "ba", "nb", "bb")
    pairs = staged(few(near.mapInArrow(_close(percent), "a bigint, b bigint").distinct(), met.count()), "near-set-pairs")

    def texts_of(some: DataFrame) -> DataFrame:
        ids = some.select("a").union(some.select("b")).distinct().withColumnRenamed("a", "cid")
        ids = staged(few(ids, 2 * some.count()), "compared")
        kept = worded.join(_sent(ids, broadcast_ids), F.col("id") == F.col("cid"), "left_semi")
        kept = staged(few(kept.distinct(), ids.count(), 256), "candidate-texts")
        return F.broadcast(kept) if (kept.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0) <= SENT_BYTES else kept

    def verified(some: DataFrame, texts: DataFrame) -> DataFrame:
        rows = some.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a").select("a", "b", "ta", "tb")
        rows = rows.mapInArrow(_linked(percent, width), "a bigint, b bigint").distinct()
        return staged(few(rows, some.count()), "set-links")

    def connected(links: DataFrame, some: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links and labels after a comparison of ``some``: the smallest partner of each document first, as it connects most groups, then what is still apart."""
        texts = texts_of(some)
        nearest = staged(few(some.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), some.count(), 256), "first-pairs")
        links = links.union(verified(nearest, texts))
        labels = components(links, broadcast_ids)
        la, lb = (_sent(labels.toDF(*c), broadcast_ids) for c in (("ia", "ca"), ("ib", "cb")))
        rest = some.join(_sent(nearest, broadcast_ids), ["a", "b"], "left_anti")
        rest = rest.join(la, F.col("a") == F.col("ia"), "left").join(lb, F.col("b") == F.col("ib"), "left")
        rest = staged(rest.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "further-pairs")
        more = verified(rest, texts) if rest.limit(1).count() else rest
        if more.limit(1).count():
            links = links.union(more)
            labels = components(links, broadcast_ids)
        return links, labels

    equal = copies.select(F.col("first").alias("a"), F.col("id").alias("b"))
    links, labels = connected(equal, pairs)
    named = members.join(_sent(labels, broadcast_ids), "id", "left").select("g", "id", F.coalesce("component", "id").alias("c"))
    # Of groups with the same members one is enough; the sets of members are told apart by 128 bits.
    sets = named.groupBy("g").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y"), F.count(F.lit(1)).alias("n"),
    ).filter("lo <> hi")
    own = few(few(sets, n_member).groupBy("x", "y", "n").agg(F.min("g").alias("g")), n_member).select("g", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = _sent(staged(own, "split-groups"), broadcast_ids)
    open_ = staged(named.join(own, "g"), "open-groups")
    if open_.limit(1).count():
        # Block x against block y of a group: a member of block h comes once for each other block and once for its own.
        dealt = open_.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("g", F.least("own", "with").alias("x"), F.greatest("own", "with").alias("y"), "own", "blocks", "id", "c")
        dealt = dealt.join(sketches, "id").repartition("g", "x", "y").sortWithinPartitions("g", "x", "y")
        across = staged(few(dealt.mapInArrow(_near(percent), "a bigint, b bigint").distinct(), n_member), "near-pairs")
        across = staged(across.join(_sent(pairs, broadcast_ids), ["a", "b"], "left_anti"), "pairs-across")
        if across.limit(1).count():
            links, labels = connected(links, across)
    named = _sent(labels.withColumnRenamed("id", "lid"), broadcast_ids)
    rows = sizes.join(named, F.col("id") == F.col("lid"), "left")
    return rows.select("id", "n_shingles", F.coalesce("component", "id").alias("component_id")), links


def op1_ngram_join(spark, folder):
    rows, _ = similarity_groups(table(spark, folder, "documents"), width=4, percent=85)
    return rows.withColumnRenamed("id", "doc_id")


QUERIES = {"op1_ngram_join": op1_ngram_join}
SQL = {
    "op1_ngram_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
pl AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS t FROM pl),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (t) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS v, doc_id AS u FROM documents UNION SELECT r.v, e.b FROM r JOIN e ON r.u = e.a)
SELECT v AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(u) AS component_id FROM r LEFT JOIN n ON n.doc_id = v GROUP BY v"""
}
