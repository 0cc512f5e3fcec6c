"""Fill-in-the-middle transformation with piece tables.

A document is a list of descriptors ``(buffer, start, end)`` over buffers that never change: its text, and one per sentinel.
Cutting a document splits the one descriptor of its text at two token borders, an arrangement permutes the descriptors and
puts sentinels between them, the inverse permutation restores the order, and hashes read the descriptors one after another, so no
rearranged copy of a text is needed until it is asked for. Tokens are a word with the blanks before it; blanks at the end are one
token. Where a document is cut, and whether and how it is rearranged, follows from a hash of its seed and id.

Token borders are found for a whole Arrow batch at once in numpy. Row by row, whole texts, no shuffle; a very long text needs its own size a
few times over in one task.

Defined results: a null text is an empty one, and stays plain; so does a text that holds a sentinel, which could not be told from
the inserted ones. A null id is hashed as an empty string. Equal rows, and rows of one id with equal token counts, are cut alike. An empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.arrays import flat, pieces
from larder.llm.common import BLANKS, prepare, table

# The sentinels of the contract before prefix, suffix and middle, and the parts in the order of each form.
SENTINELS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
PARTS = ("prefix", "middle", "suffix")
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}

BLANK = np.zeros(256, bool)
BLANK[list(BLANKS.encode())] = True
SCHEMA = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"


class Descriptor(NamedTuple):
    buffer: int
    start: int
    end: int


class PieceTable:
    """Descriptors over immutable buffers."""

    def __init__(self, buffers: list[bytes], descriptors: list[Descriptor]):
        self.buffers, self.descriptors = buffers, descriptors

    @classmethod
    def whole(cls, *buffers: bytes) -> PieceTable:
        """The first buffer as one piece; the others are at hand for insertion."""
        return cls(list(buffers), [Descriptor(0, 0, len(buffers[0]))])

    def cut(self, at: list[int]) -> PieceTable:
        """Split descriptors at offsets of the document; every offset gives a border, also if a piece gets empty."""
        out, begin, at = [], 0, sorted(at)
        for d in self.descriptors:
            start, size = d.start, d.end - d.start
            while at and at[0] <= begin + size:
                border = d.start + at.pop(0) - begin
                out.append(Descriptor(d.buffer, start, border))
                start = border
            out.append(Descriptor(d.buffer, start, d.end))
            begin += size
        return PieceTable(self.buffers, out)

    def permuted(self, order: list[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.descriptors[i] for i in order])

    def marked(self, buffers: list[int]) -> PieceTable:
        """The whole buffer of that number before each descriptor."""
        out = [x for b, d in zip(buffers, self.descriptors) for x in (Descriptor(b, 0, len(self.buffers[b])), d)]
        return PieceTable(self.buffers, out)

    def only(self, buffer: int) -> PieceTable:
        return PieceTable(self.buffers, [d for d in self.descriptors if d.buffer == buffer])

    def stream(self) -> Iterator[memoryview]:
        for d in self.descriptors:
            yield memoryview(self.buffers[d.buffer])[d.start : d.end]

    def digest(self) -> str:
        out = sha256()
        for part in self.stream():
            out.update(part)
        return out.hexdigest()

    def text(self) -> bytes:
        return b"".join(self.stream())


def arrange(text: bytes, low: int, high: int, form: str, sentinels: dict[str, bytes]) -> PieceTable:
    """Text cut at two byte offsets and arranged; buffers are the text, then the sentinels in the order of the form."""
    order = FORMS[form]
    cut = PieceTable.whole(text, *[sentinels[p] for p in order]).cut([low, high])
    return cut.permuted([PARTS.index(p) for p in order]).marked([1, 2, 3])


def restore(output: bytes, form: str, sentinels: dict[str, bytes]) -> PieceTable:
    """The text of an arranged output: cut at the sentinels, drop them, and undo the permutation."""
    if form not in FORMS:
        return PieceTable.whole(output)
    order = FORMS[form]
    at, edges = 0, []
    for part in order:
        at = output.index(sentinels[part], at)
        edges += [at, at + len(sentinels[part])]
        at = edges[-1]
    parts = PieceTable.whole(output).cut(edges).permuted([2, 4, 6])
    return parts.permuted([order.index(p) for p in PARTS])


class Borders:
    """Token borders and code points of the texts of one batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        blank = BLANK[data]
        self.starts, self.stops = offsets[:-1], offsets[1:]
        last = self.stops[self.stops > self.starts] - 1
        ends = ~blank
        ends[:-1] &= blank[1:]
        ends[last] = ~blank[last]
        self.words = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.words, self.starts, side="right")
        self.n_words = np.searchsorted(self.words, self.stops, side="right") - self.first
        last = blank[np.maximum(self.stops - 1, 0)] if len(data) else np.zeros(len(self.stops), bool)
        self.n = self.n_words + (last & (self.stops > self.starts))
        self.points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])

    def offset(self, row: int, tokens: int) -> int:
        """Bytes of a row before its token of that number."""
        if tokens == 0:
            return 0
        end = self.words[self.first[row] + tokens - 1] if tokens <= self.n_words[row] else self.stops[row]
        return int(end - self.starts[row])

    def chars(self, row: int, low: int, high: int) -> int:
        begin = self.starts[row]
        return int(self.points[begin + high] - self.points[begin + low])


def check(sentinels: list[bytes]) -> None:
    """Sentinels that could begin inside another, or inside a text that holds none, cannot be told apart."""
    for i, s in enumerate(sentinels):
        for j, t in enumerate(sentinels):
            if not s or (i != j and s in t) or any(t.endswith(s[:k]) for k in range(1, len(s))):
                raise ValueError(f"sentinels {s!r} and {t!r} are empty or overlap")


def _transform(sentinels: dict[str, bytes], rate: int, spm_rate: int, texts: bool):
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            data, offsets = flat(piece.column("text"))
            raw, borders = data.tobytes(), Borders(data, offsets)
            draws = np.stack([np.asarray(piece.column(f"h{i}")) for i in (1, 2, 3, 4)], axis=1)
            rows, outputs = [], []
            for i, (h1, h2, h3, h4) in enumerate(draws.tolist()):
                text, n, form = raw[offsets[i] : offsets[i + 1]], int(borders.n[i]), "plain"
                chars, made = (None, None), PieceTable.whole(text)
                if text and h3 % 100 < rate and not any(s in text for s in sentinels.values()):
                    low, high = sorted((borders.offset(i, h1 % (n + 1)), borders.offset(i, h2 % (n + 1))))
                    form = "spm" if h4 % 100 < spm_rate else "psm"
                    chars = borders.chars(i, 0, low), borders.chars(i, low, high)
                    made = arrange(text, low, high, form, sentinels)
                output = made.text()
                rows.append((n, form, *chars, made.digest(), restore(output, form, sentinels).digest()))
                outputs.append(output)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
            columns = [piece.column("id")] + [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            if texts:
                columns.append(pa.array([o.decode("utf-8", "replace") for o in outputs], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", *names, *(["output"] if texts else [])])

    return transform


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def fill_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: int = 50,
    spm_rate: int = 80,
    seed: int = 42,
    sentinels: dict[str, str] = SENTINELS,
    texts: bool = True,
) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256[, output])`` of every row.

    ``rate`` per cent of the documents are arranged, ``spm_rate`` per cent of these with the suffix in front. With ``texts=False`` only the digests leave
    the tasks.
    """
    prepare(docs.sparkSession)
    marks = {p: s.encode() for p, s in sentinels.items()}
    check(list(marks.values()))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), *draws(F.col(id_col), seed))
    schema = f"id {kind}, {SCHEMA}" + (", output string" if texts else "")
    return rows.mapInArrow(_transform(marks, rate, spm_rate, texts), schema)


def restored(rows: DataFrame, sentinels: dict[str, str] = SENTINELS) -> DataFrame:
    """Rows of ``fill_middle`` with their text rebuilt from ``output`` and ``form`` as ``text``."""
    out = F.col("output")

    def between(form: str, part: str) -> Column:
        order = FORMS[form]
        tail = F.substring_index(out, sentinels[part], -1)
        at = order.index(part)
        return tail if at == 2 else F.substring_index(tail, sentinels[order[at + 1]], 1)

    parts = {f: F.concat(*[between(f, p) for p in PARTS]) for f in FORMS}
    return rows.withColumn("text", F.when(F.col("form") == "psm", parts["psm"]).when(F.col("form") == "spm", parts["spm"]).otherwise(out))


def op11_fill_middle(spark, folder):
    return fill_middle(table(spark, folder, "documents"), texts=False).withColumnRenamed("id", "doc_id")


_TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
QUERIES = {"op11_fill_middle": op11_fill_middle}
SQL = {
    "op11_fill_middle": f"""
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
cut AS (SELECT doc_id, body, regexp_extract_all(body, '{_TOKEN}') AS u, len(u) AS n,
    ('0x' || substr(x, 1, 8))::UBIGINT % (n + 1) AS k1, ('0x' || substr(x, 9, 8))::UBIGINT % (n + 1) AS k2,
    CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
        OR ('0x' || substr(x, 17, 8))::UBIGINT % 100 >= 50 THEN 'plain'
        WHEN ('0x' || substr(x, 25, 8))::UBIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, coalesce(array_to_string(u[1:least(k1, k2)::BIGINT], ''), '') AS a,
    coalesce(array_to_string(u[least(k1, k2)::BIGINT + 1:greatest(k1, k2)::BIGINT], ''), '') AS b,
    coalesce(array_to_string(u[greatest(k1, k2)::BIGINT + 1:], ''), '') AS c FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN body ELSE a || b || c END) AS restored_sha256
FROM parts""",
}
