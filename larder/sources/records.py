"""Records cut out of JSON files by many tasks, and the table of what could not be read.

A JSON array may be one file of any size. Spark reads it in byte blocks, at commas. What a block does to the JSON state is a small
function: for either entry state, inside a string or not, it gives the exit state, the change of depth and the commas at each relative depth. These
functions compose in the order of the blocks to the state at the start of every block, so a second pass cuts each block by itself at the
commas of depth one. Only elements that reach over a block border are put together after a shuffle. Files of one block need one pass.

A raw line break cannot stand in a JSON string, so it ends any string; an unclosed quote spoils one element and not the rest. Brackets
that do not match spoil everything behind them, unless the file has one element per line: then the lines are read one by one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.session import ship_package, staged

QUOTE, BACKSLASH, NEWLINE, COMMA, OPEN, CLOSE = (ord(c) for c in '"\\\n,[]')
BLANK = b" \t\r\n"
SAMPLE = 200  # bytes of an unreadable text that are kept for inspection
WHOLE, BEGINS, MIDDLE, ENDS = range(4)

STEP = np.zeros(256, np.int8)
STEP[[ord("["), ord("{")]], STEP[[ord("]"), ord("}")]] = 1, -1

EFFECT = (
    "file string, block bigint, root string, tail string, bytes bigint, lines bigint, by_line boolean, s0 int, s1 int, d0 bigint, d1 bigint, "
    "c0 map<bigint,bigint>, c1 map<bigint,bigint>"
)
CUT = "file string, block bigint, pos bigint, at bigint, part int, value binary, reason string"


def structure(data: np.ndarray, string: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Which bytes stand outside strings, the depth behind every byte, and whether the last byte leaves a string open."""
    quote = data == QUOTE
    slashes = np.flatnonzero(data == BACKSLASH)
    if len(slashes):
        first = np.flatnonzero(np.concatenate([[True], np.diff(slashes) != 1]))
        lengths = np.diff(np.append(first, len(slashes)))
        behind = slashes[first] + lengths
        quote[behind[(lengths & 1 == 1) & (behind < len(data))]] = False
    count = np.cumsum(quote, dtype=np.int32)
    ends = np.flatnonzero(data == NEWLINE)
    base = np.repeat(np.concatenate([[string], count[ends]]), np.diff(np.concatenate([[0], ends + 1, [len(data)]])))
    outside = (count - quote + base) & 1 == 0
    after = depth + np.cumsum(np.where(outside, STEP[data], 0), dtype=np.int64)
    return outside & ~quote, after, int(count[-1] + base[-1]) & 1 if ends.size == 0 or ends[-1] + 1 < len(data) else 0


def element_lines(raw: bytes, most: int = 32) -> bool | None:
    """Whether half of the first whole lines or more are one object each; None without a line break."""
    lines = raw.split(b"\n", most)[:-1]
    if not lines:
        return None
    good = total = 0
    for line in lines:
        inner = line.strip(BLANK).removesuffix(b",").removeprefix(b"[").strip(BLANK)
        if inner in (b"", b"]"):
            continue
        total += 1
        try:
            good += isinstance(json.loads(inner), dict)
        except ValueError:
            pass
    return good > 0 and good * 2 >= total


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes | None]]:
    """``(block, bytes)`` of rows cut at commas, in order, the commas put back; ``None`` ends a block."""
    now: dict | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file").dictionary_encode().indices, np.asarray(batch.column("block"))
        change = np.flatnonzero((np.diff(np.asarray(file)) != 0) | (np.diff(block) != 0)) + 1
        others = [n for n in batch.schema.names if n != "value"]
        for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            head = {n: batch.column(n)[a].as_py() for n in others}
            raw = b",".join([v or b"" for v in batch.column("value").slice(a, b - a).to_pylist()])
            if now is not None and (now["file"], now["block"]) == (head["file"], head["block"]):
                raw = b"," + raw
            elif now is not None:
                yield now, None
            now = head
            yield now, raw
    if now is not None:
        yield now, None


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does to the JSON state; every block but a file's last goes on with a comma."""
    state: dict | None = None
    for head, raw in blocks(batches):
        if raw is None:
            columns = {n: [state[n]] for n in ("file", "block", "root", "tail", "bytes", "lines", "by_line", "s0", "s1", "d0", "d1")}
            made = pa.RecordBatch.from_pydict(columns | {f"c{e}": [list(state[f"c{e}"].items())] for e in (0, 1)}, schema=_arrow(EFFECT))
            state = None
            yield made
            continue
        if state is None:
            state = {"file": head["file"], "block": head["block"], "root": None, "tail": None, "bytes": 1, "lines": 0, "by_line": None}
            state |= {"s0": 0, "s1": 1, "d0": 0, "d1": 0, "c0": {}, "c1": {}}
        if not raw:
            continue
        data = np.frombuffer(raw, np.uint8)
        state["bytes"] += len(raw)
        state["lines"] += int(np.count_nonzero(data == NEWLINE))
        shown = raw.strip(BLANK)
        state["tail"] = chr(shown[-1]) if shown else state["tail"]
        if state["by_line"] is None:
            state["by_line"] = element_lines(raw)
        for e in (0, 1):
            outside, after, string = structure(data, state[f"s{e}"], state[f"d{e}"])
            if e == 0 and state["root"] is None and shown:
                state["root"] = chr(shown[0])
            levels, counts = np.unique(after[outside & (data == COMMA)], return_counts=True)
            for level, n in zip(levels.tolist(), counts.tolist()):
                state[f"c{e}"][level] = state[f"c{e}"].get(level, 0) + n
            state[f"s{e}"], state[f"d{e}"] = string, int(after[-1])


def _arrow(ddl: str) -> pa.Schema:
    kinds = {
        "string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(),
        "map<bigint,bigint>": pa.map_(pa.int64(), pa.int64()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in ddl.split(", "))])


class Cutter:
    """Cuts one block into elements, given the state at its start."""

    def __init__(self, head: dict):
        self.file, self.block, self.root, self.last = head["file"], head["block"], head["root"], head["last"]
        self.string, self.depth, self.pos, self.at = head["string"], head["depth"], head["pos"], head["start"]
        self.by_line, self.lost, self.start = head["by_line"], head["lost"], head["start"]
        self.layout: bool | None = None
        self.held: list[bytes] = []
        self.carried = head["start"] > 0  # the held text began in an earlier block
        self.inside = self.depth > 0 or self.by_line  # it stands in the root array, not before or behind it
        self.rows: list[tuple] = []

    def feed(self, raw: bytes) -> None:
        if not raw:
            return
        if self.root is None:
            shown = raw.lstrip(BLANK)
            self.root = chr(shown[0]) if shown else None
        if self.by_line:
            marks = np.flatnonzero(np.frombuffer(raw, np.uint8) == NEWLINE)
            kinds = np.full(len(marks), NEWLINE)
        elif self.root == "[":
            data = np.frombuffer(raw, np.uint8)
            outside, after, self.string = structure(data, self.string, self.depth)
            if self.layout is None:
                self.layout = element_lines(raw)
            self.depth = int(after[-1])
            border = ((data == OPEN) | (data == COMMA)) & (after == 1) | (STEP[data] < 0) & (after == 0)
            marks = np.flatnonzero(outside & border)
            kinds = data[marks]
        else:
            marks = kinds = np.empty(0, np.int64)
        begin = 0
        for mark, kind in zip(marks.tolist(), kinds.tolist()):
            self.held.append(raw[begin:mark])
            self._element(kind)
            self.at += 1
            begin = mark + 1
        self.held.append(raw[begin:])

    def _element(self, kind: int) -> None:
        """The held text ends at a border of this kind."""
        text, self.held = b"".join(self.held), []
        if not self.inside:
            if text.strip(BLANK):
                self._row(text, WHOLE, "outside the root")
        elif self.carried:
            self._row(text, ENDS)
        elif self.by_line:
            self._line(text)
        elif text.strip(BLANK):
            self._row(text, WHOLE)
        elif kind == COMMA or self.after_comma:
            self._row(text, WHOLE, "empty element")
        self.at += len(text)
        self.carried, self.after_comma = False, kind == COMMA
        self.inside = self.by_line or kind == OPEN or (kind == COMMA and self.inside)
        self.pos += kind in (COMMA, NEWLINE)

    after_comma = False

    def _line(self, text: bytes) -> None:
        """A line of an array that has one element per line."""
        inner = text.strip(BLANK).removesuffix(b",").rstrip(BLANK)
        if inner[:1] == b"[" and self.at == 0:
            inner = inner[1:]
        if inner[:1] == b"{" and inner[-1:] == b"]":
            inner = inner[:-1]
        if inner.strip(BLANK) not in (b"", b"[", b"]"):
            self._row(inner, WHOLE, at=self.at + text.find(inner))

    def _row(self, text: bytes, part: int, reason: str | None = None, at: int | None = None) -> None:
        if at is None:
            at = self.at + (len(text) - len(text.lstrip(BLANK)) if part == WHOLE else 0)
        part += BY_LINE if self.by_line and part != WHOLE else 0
        self.rows.append((self.file, self.block, self.pos, at, part, text if reason is None else text[:SAMPLE], reason))

    def end(self) -> None:
        """The block ends: what is held goes on in the next block, or is the last of the file."""
        if not self.last:
            self.feed(b",")
        text = b"".join(self.held)
        if self.root is not None and self.root != "[" and not self.by_line:  # one value fills the file
            if not self.last:
                self._row(text, MIDDLE if self.carried else BEGINS)
            elif self.carried or text.strip(BLANK):
                self._row(text, ENDS if self.carried else WHOLE)
        elif not self.inside:
            if text.strip(BLANK):
                self._row(text, WHOLE, "outside the root")
        elif self.by_line and self.last:
            self._row(text, ENDS) if self.carried else self._line(text)
        elif self.last and self.depth == 1 and not self.string and text.strip(BLANK)[-1:] not in (b"", b"]"):
            self._row(text, ENDS if self.carried else WHOLE)
        elif self.last and self.start == 0:
            self._salvage(text)
        elif self.lost == self.pos and not self.by_line:
            if not self.carried:
                self._row(text, WHOLE, "unclosed")
        else:
            self._row(text, MIDDLE if self.carried else BEGINS)

    def _salvage(self, text: bytes) -> None:
        """The rest of a file that ends inside its array."""
        lines = text.split(b"\n") if self.layout else [text]
        if not text.strip(BLANK):
            return
        if len(lines) == 1:
            self._row(text, WHOLE, "unclosed")
            return
        for line in lines:
            self._line(line)
            self.at, self.pos = self.at + len(line) + 1, self.pos + 1

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * 7
        self.rows = []
        schema = _arrow(CUT)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter: Cutter | None = None
    for head, raw in blocks(batches):
        if cutter is None:
            cutter = Cutter(head)
        if raw is None:
            cutter.end()
        else:
            cutter.feed(raw)
        if cutter.rows:
            yield cutter.taken()
        if raw is None:
            cutter = None


def _pieces(spark: SparkSession, path: str, glob: str, split_only: bool = False) -> DataFrame:
    """Files cut at commas. Both passes list the same files, so that Spark splits them alike."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", ",")
    rows = reader.text(path)
    if split_only:  # a test of the row as well, as a test of metadata alone would leave files out of the listing
        split = F.col("_metadata.file_block_length") < F.col("_metadata.file_size")
        rows = rows.filter(F.when(F.octet_length("value") >= 0, split))
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )


def block_states(effects: DataFrame) -> DataFrame:
    """State at the start of every block: ``file, block, root, string, depth, pos, start, last, by_line, lost``.

    ``start`` is the byte offset, ``pos`` the number of elements before. ``by_line`` files end inside their array and hold one element per
    line; ``lost`` is the number of the element that is never closed.
    """
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    sum_before = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    fixed = F.col("s0") == F.col("s1")  # a block with a line break leaves its own state, whatever came before
    turns = F.when(~fixed, F.col("s0")).otherwise(0)
    rows = effects.withColumn("_turns", sum_before(turns))
    rows = rows.withColumn("_fix", F.last(F.when(fixed, F.struct("s0", "_turns")), ignorenulls=True).over(before))
    known = F.col("_fix.s0") + F.col("_turns") - F.col("_fix._turns")
    rows = rows.withColumn("string", F.pmod(F.coalesce(known, F.col("_turns")), F.lit(2)).cast("int"))
    inside = F.col("string") == 1
    rows = rows.withColumn("_d", F.when(inside, F.col("d1")).otherwise(F.col("d0"))).withColumn("depth", sum_before("_d"))
    commas = F.when(inside, F.col("c1")).otherwise(F.col("c0"))
    rows = rows.withColumn("_c", F.coalesce(F.try_element_at(commas, 1 - F.col("depth")), F.lit(0)))
    rows = rows.withColumn("_exit", F.when(inside, F.col("s1")).otherwise(F.col("s0")))
    rows = rows.withColumn("last", F.row_number().over(order) == F.count(F.lit(1)).over(whole))
    border = ~F.col("last") & (F.col("_exit") == 0) & (F.col("depth") + F.col("_d") == 1)  # the comma behind the block
    rows = rows.withColumn("_c", F.col("_c") + border.cast("bigint"))
    rows = rows.withColumn("_tail", F.last("tail", ignorenulls=True).over(order))
    depth = F.col("depth") + F.col("_d")
    closed = (depth == 0) | (depth == 1) & (F.col("_tail") != "]")  # an array that lacks its last bracket alone loses nothing
    broken = F.max(F.when(F.col("last"), ~closed | (F.col("_exit") != 0))).over(whole)
    rows = rows.withColumn("root", F.first("root", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rows = rows.withColumn("_broken", broken & (F.col("root") == "["))
    lined = F.first("by_line", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("by_line", F.coalesce(F.col("_broken") & lined, F.lit(False)))
    number = F.when(F.col("by_line"), F.col("lines")).when(F.col("root") == "[", F.col("_c")).otherwise(0)
    rows = rows.withColumn("pos", sum_before(number)).withColumn("_all", F.sum(number).over(whole))
    return rows.select(
        "file", "block", "root", "string", "depth", "pos", sum_before("bytes").alias("start"), "last", "by_line",
        F.when(F.col("_broken"), F.col("_all")).alias("lost"),
    )


# State of a file that is one block.
ALONE = {"root": None, "string": 0, "depth": 0, "pos": 0, "start": 0, "last": True, "by_line": False, "lost": None}
KINDS = {"string": "int", "depth": "bigint", "pos": "bigint", "start": "bigint", "last": "boolean", "by_line": "boolean", "lost": "bigint"}
BY_LINE = 10  # added to the part of a text that is a line
SENT_BLOCKS = 1_000_000  # states of up to so many blocks are sent to the tasks; beyond, the pieces are dealt to them


def json_elements(spark: SparkSession, path: str, glob: str, sent_blocks: int = SENT_BLOCKS) -> DataFrame:
    """Elements of root arrays, or other roots whole, as text: ``file, block, pos, at, value, reason``.

    ``pos`` numbers the elements of a file, ``at`` is the byte offset. A ``reason`` marks what is no element of a well-formed array; its
    ``value`` is a sample. Whether a value is JSON is not looked at.
    """
    ship_package(spark)
    rows = _pieces(spark, path, glob)
    if _may_split(spark, path, glob):
        effects = _pieces(spark, path, glob, split_only=True).mapInArrow(_effects, EFFECT)
        states = staged(block_states(effects), "block-states")
        if states.count() <= sent_blocks:
            rows = rows.join(F.broadcast(states), ["file", "block"], "left")
        else:
            rows = rows.withColumn("_n", F.monotonically_increasing_id()).join(states, ["file", "block"], "left")
            rows = rows.repartition("file", "block").sortWithinPartitions("file", "block", "_n")
        state = [F.coalesce(c, F.lit(v)).alias(c) if v is not None else F.col(c) for c, v in ALONE.items()]
    else:
        state = [F.lit(v).cast(KINDS.get(c, "string")).alias(c) for c, v in ALONE.items()]
    cut = staged(rows.select("file", "block", *state, "value").mapInArrow(_cut, CUT), "json-elements")
    text = F.col("value").cast("string")
    whole = cut.filter(F.col("part") == WHOLE).select("file", "block", "pos", "at", text.alias("value"), "reason")
    parts = cut.filter(F.col("part") != WHOLE).groupBy("file", "pos")
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("p"), F.max("part").alias("part"))
    joined = F.array_join(F.transform("p", lambda x: x["value"].cast("string")), "")
    parts = parts.withColumn("value", joined).withColumn("block", F.col("p")[0]["block"])
    lead = F.length("value") - F.length(F.regexp_replace("value", r"^[ \t\r\n]+", ""))
    parts = parts.withColumn("at", F.col("p")[0]["at"] + lead)
    line = F.regexp_replace(F.regexp_replace("value", r"^\s+|[\s,]+$", ""), r"^(\{.*\})\]$", "$1")
    by_line = F.col("part") >= BY_LINE
    parts = parts.withColumn("value", F.when(by_line, line).otherwise(F.col("value")))
    parts = parts.filter(~by_line | ~F.col("value").isin("", "[", "]"))
    empty = F.when(F.trim(F.translate("value", "\t\r\n", "   ")) == "", F.lit("empty element"))
    return whole.unionByName(parts.select("file", "block", "pos", "at", "value", empty.alias("reason")))


def _may_split(spark: SparkSession, path: str, glob: str) -> bool:
    """Whether a file is large enough to be read in several blocks."""
    limits = [spark.conf.get(f"spark.sql.files.{n}") for n in ("maxPartitionBytes", "openCostInBytes")]
    least = min(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(x) for x in limits)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return (files.agg(F.max("length")).first()[0] or 0) > least
