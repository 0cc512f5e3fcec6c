"""Best-fit decreasing packing of tokenised documents into sequences of a fixed length.

Tasks turn texts to token ids and longer documents into full pieces and a rest. Best-fit decreasing then takes the pieces from the longest to the
shortest and puts each into the open sequence with the least room that is enough, which a segment tree over the remaining
capacities names in logarithmic time. Pieces of one length are alike to it, and so are sequences with one remaining capacity. So the tree
need not see the pieces: Spark counts them by length, a table of at most ``capacity`` rows however large the corpus, and each
question to the tree is answered for as many pieces of that length as the group of alike sequences takes. The result is the same as piece by
piece over the whole corpus. The plan says for each range of pieces of a length which sequences, and which place in them, they take; pieces find their
range by their rank within their length, which Spark derives from ranks inside the tasks and the counts of earlier tasks. Only narrow
rows are shuffled, dealt by length and task, so no length, source or text is hot.

Tokens of a text are those of its words, cut at blanks, one after another: the tokenizer turns blanks to word ends and looks at no word's neighbours. Each
word is therefore encoded once, as long as a task remembers it.

Defined results: a null or empty text has the end token alone. Equal rows and rows without an id are packed like others. A very long text is cut like any
other and takes its own size a few times over in one task. Sequence numbers and which of equally long pieces goes where may change with the input splits,
the number of sequences and their fill may not. An empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.arrays import flat, pieces
from larder.llm.common import BLANKS, prepare, table
from larder.session import staged


# How the tokenizer file splits words. Plain words are split here by the same rule, a batch at a time.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NONE, LETTER, DIGIT, OTHER = range(4)
LATIN = 0xC3  # first of the two bytes of the letters from À to ÿ


def byte_letters() -> dict[int, str]:
    """Byte-level letters: printable bytes stand for themselves, the others for the letters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}


class UnitIds:
    """Numbers of units and the token ids of each; forgets them when they get many.

    A unit is a part of a plain word (letters, one digit, or other signs), lower-cased, or a whole word that is not plain: with
    an apostrophe, the beginning of a special token, or letters beyond the Latin ones of one or two bytes. All words are of that kind to a tokenizer of
    another rule.
    """

    def __init__(self, definition: str, most: int = 500_000, most_bytes: int = 32 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.most_bytes = Tokenizer.from_str(definition), most, most_bytes
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.letters = self.tokenizer.model, byte_letters()
        parts = json.loads(definition)
        rules = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        known = rules == NORMALIZERS and [x["type"] for x in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"] == {"Regex": RULE}
        self.kind = np.full(256, OTHER, np.uint8)
        for name, kind in (("abcdefghijklmnopqrstuvwxyz", LETTER), ("0123456789", DIGIT), (BLANKS, NONE)):
            self.kind[list(name.encode())] = kind
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.odd = np.ones(256, bool)
        if known:
            self.odd[0x21:0x7F] = False
            self.odd[ord("'")] = True
            for token in parts["added_tokens"]:
                signs = [b for b in token["content"].encode() if self.kind[self.lower[b]] == OTHER]
                self.odd[signs[:1] or range(256)] = True
        self.odd[list(BLANKS.encode())] = False
        self.splits = not self.odd[ord("a")]
        signs = b"".join(re.escape(bytes([b])) for b in range(0x21, 0x7F) if not self.odd[b])
        self.plain = re.compile(rb"(?:[" + signs + rb"]|\xc3[\x80-\xbf])+" if self.splits else b"$^")
        self._reset()

    def _reset(self) -> None:
        self.known, self.ids, self.starts = pa.array([], pa.binary()), np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _of(self, unit: bytes) -> list[int]:
        if not self.plain.fullmatch(unit):
            return self.tokenizer.encode(unit.decode("utf-8", "replace"), add_special_tokens=False).ids
        letters = unit.decode("latin-1")
        return [t.id for t in self.model.tokenize(letters if unit.isascii() else letters.translate(self.letters))]

    def numbers(self, units: pa.Array) -> np.ndarray:
        """Number of each unit; new ones are numbered on."""
        units = units.dictionary_encode()
        found = pc.index_in(units.dictionary, value_set=self.known)
        missing = np.asarray(pc.is_null(found))
        out = np.array(pc.fill_null(found, 0))
        if missing.any():
            new = units.dictionary.filter(pa.array(missing))
            out[missing] = np.arange(len(self.known), len(self.known) + len(new))
            flat, ends, at = [], [], len(self.ids)
            for unit in new.to_pylist():
                flat += self._of(unit)
                ends.append(at + len(flat))
            self.known = pa.concat_arrays([self.known, new])
            self.ids = np.concatenate([self.ids, np.array(flat, np.uint32)])
            self.starts = np.concatenate([self.starts, np.array(ends, np.int64)])
        return out[np.asarray(units.indices)]

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """All units of the rows of a flat binary column, and the number of units before each row."""
        low = self.lower[data]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        second = np.zeros(len(data), bool)
        second[1:] = (data[:-1] == LATIN) & (data[1:] & 0xC0 == 0x80)
        second[heads] = False
        at = np.flatnonzero(second)
        kind, odd = self.kind[low], self.odd[data]
        sign = (data[at] == 0x97) | (data[at] == 0xB7)  # × and ÷ are no letters
        low[at[~sign & (data[at] < 0x9F)]] += 0x20
        kind[at] = kind[at - 1] = np.where(sign, OTHER, LETTER)
        if self.splits:
            odd[at] = odd[at - 1] = False
        shown = kind != NONE
        new = shown.copy()
        new[1:] &= ~shown[:-1]
        new[heads] = shown[heads]
        words = np.append(np.flatnonzero(new), len(data))  # a word goes on to blanks or the next row
        split = shown.copy()
        split[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        strange = np.unique(np.searchsorted(words, np.flatnonzero(odd & shown), side="right") - 1)
        for a, b in zip(words[strange].tolist(), words[strange + 1].tolist()):
            split[a:b] = False
            low[a:b] = data[a:b]
        new |= split
        new[at] = False
        starts, blanks = np.flatnonzero(new), np.flatnonzero(~shown)
        borders = np.append(starts - np.searchsorted(blanks, starts), len(data) - len(blanks)).astype(np.int32)
        made = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(low[shown])])
        return made, np.searchsorted(starts, offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and where each row begins."""
        if len(self.known) > self.most or self.known.nbytes > self.most_bytes:
            self._reset()
        units, rows = self.units(data, offsets)
        numbers = self.numbers(units)
        begin, width = self.starts[:-1].astype(np.int32), np.diff(self.starts).astype(np.int32)
        sizes = width[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        shift = begin[numbers] - ends[:-1].astype(np.int32)
        return self.ids[np.arange(ends[-1], dtype=np.int32) + np.repeat(shift, sizes)], ends[rows]


@lru_cache(maxsize=2)
def _unit_ids(definition: str) -> UnitIds:
    return UnitIds(definition)


def _pieces(definition, capacity: int, end: int, ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, task = _unit_ids(definition.value), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in pieces(batches, "text", 2 << 20):
            tokens, borders = units.encode(*flat(batch.column("text")))
            row, number, start, length, crc, place, kept = [], [], [], [], [], [], []
            for i, (a, b) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())):
                document = np.append(tokens[a:b], np.uint32(end)).astype("<u4")
                for n, at in enumerate(range(0, len(document), capacity)):
                    part = document[at : at + capacity]
                    raw, size = part.tobytes(), len(part)
                    row.append(i), number.append(n), start.append(at), length.append(size), crc.append(zlib.crc32(raw))
                    place.append(int(seen[size]))
                    seen[size] += 1
                    if ids:
                        kept.append(part)
            columns = {
                "id": batch.column("id").take(pa.array(row, pa.int64())), "piece": pa.array(number, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "task": pa.array([task] * len(row), pa.int32()), "place": pa.array(place, pa.int64()),
            }
            if ids:
                columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return cut


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end: int = 1, ids: bool = True
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, task, place[, ids])``: the pieces of every row, the end token being the last.

    ``place`` numbers the pieces of one length within a task. ``tokenizer`` is a file of the ``tokenizers`` library that ends words at blanks; the driver
    reads it and sends it to the tasks.
    """
    spark = docs.sparkSession
    prepare(spark)
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_pieces(definition, capacity, end, ids), schema + (", ids array<int>" if ids else ""))


class Capacities:
    """Segment tree over the remaining capacities 0 to ``most``: which of them some open sequence has."""

    def __init__(self, most: int):
        self.width = 1 << max(1, most.bit_length())
        self.any = bytearray(2 * self.width)

    def mark(self, capacity: int, there: bool) -> None:
        node = capacity + self.width
        self.any[node] = there
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] | self.any[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity there is that is not below ``least``."""
        node = least + self.width
        if self.any[node]:
            return least
        while node > 1:
            if not node & 1 and self.any[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.width:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.width


class Range(NamedTuple):
    """Pieces of a length, ``rank`` to the next range's: ``each`` per sequence from ``sequence`` on, the first at ``offset``."""

    length: int
    rank: int
    each: int
    sequence: int
    offset: int


def best_fit(counts: dict[int, int], capacity: int) -> list[Range]:
    """Best-fit decreasing of ``counts`` pieces by length into sequences of ``capacity``."""
    tree, plan, sequences = Capacities(capacity), [], 0
    groups: dict[int, list[tuple[int, int]]] = {}  # remaining capacity: (first sequence, number of sequences)

    def open_group(room: int, first: int, number: int) -> None:
        if number and room:
            groups.setdefault(room, []).append((first, number))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, number = capacity, -(-left // (capacity // length))
                first = sequences
                sequences += number
            else:
                first, number = groups[room].pop()
                if not groups[room]:
                    tree.mark(room, False)
            each = room // length
            plan.append(Range(length, rank, each, first, capacity - room))
            full, rest = divmod(min(left, number * each), each)
            open_group(room - each * length, first, full)
            open_group(room - rest * length, first + full, 1 if rest else 0)
            if room < capacity:
                untouched = full + (1 if rest else 0)
                open_group(room, first + untouched, number - untouched)
            rank, left = rank + full * each + rest, left - full * each - rest
    return plan


def _assign(plan: np.ndarray):
    by_length = np.searchsorted(plan[:, 0], np.arange(int(plan[-1, 0]) + 2)) if len(plan) else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            at = np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
                a, b = by_length[length[some[0]]], by_length[length[some[0]] + 1]
                at[some] = a + np.searchsorted(plan[a:b, 1], rank[some], side="right") - 1
            _, first_rank, each, sequence, offset = plan[at].T
            places = [pa.array(sequence + (rank - first_rank) // each), pa.array(offset + (rank - first_rank) % each * length)]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + places, names=[*kept, "sequence_id", "offset"])

    return assign


def pack(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """Rows of ``token_pieces`` with ``sequence_id`` and ``offset`` instead of ``task`` and ``place``."""
    cut = staged(cut, "token-pieces")
    sizes = staged(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(sorted(best_fit(counts, capacity)), np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    kept = [c for c in cut.columns if c not in ("task", "place")]
    ranked = cut.join(offsets, ["length", "task"]).select(*kept, (F.col("_before") + F.col("place")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(_assign(plan), f"{schema}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, parts)``: the token ids of each sequence, and ``(offset, id, piece)`` of what it holds."""
    part = F.struct("offset", "id", "piece", "ids")
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.transform("p", lambda x: x.dropFields("ids")).alias("parts"))


def op13_packing(spark, folder):
    import public_tokenizers

    cut = token_pieces(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=False)
    return pack(cut).withColumnRenamed("id", "doc_id")


QUERIES = {"op13_packing": op13_packing}
SQL: dict[str, str] = {}
