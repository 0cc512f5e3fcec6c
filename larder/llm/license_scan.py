"""License notices in texts: exact phrases, and fuzzy search of short notices.

A notice of ``m`` characters may differ in k = m // ``per_error`` edits. It is cut into k + 2 pieces: by the
pigeonhole principle at least two stand unchanged in any place the notice matches, and edits move one against the other by k at most. One
automaton finds all pieces of all notices in a normalised text (A-Z lower-cased words, one blank between); around two different pieces
that agree so, the ``regex`` library verifies the whole notice with at most k edits and gives its span. All other texts, most of them,
cost one pass of the automaton. Row by row, whole texts, no shuffle.

Defined results: a null or empty text has no words and no labels. A match has to begin and end at word borders.
Of overlapping matches of one notice the best stays; what lies before and behind it is searched on. Ties and equal rows get equal results; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.arrays import pieces
from larder.llm.common import prepare, table

# The phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Short notices and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "mozilla public license": "mpl",
    "licensed under cc by nc 4 0": "cc by nc",
    "licensed under creative commons": "cc",
    "all rights reserved": "proprietary",
}
# Everything but ASCII letters, digits and bytes of other characters is a separator.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SPAN = "array<struct<label:string,start:bigint,end:bigint,errors:int,length:int>>"
SCHEMA = f"id string, n_words bigint, base array<struct<label:string,word:bigint>>, spans {SPAN}"


class Notices:
    def __init__(self, notices: dict[str, str], per_error: int):
        import ahocorasick
        import regex

        self.rules, seeds = [], {}
        for n, (text, label) in enumerate(notices.items()):
            errors = len(text) // per_error
            cuts = [len(text) * i // (errors + 2) for i in range(errors + 3)]
            pattern = regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(text)}){{e<={errors}}}(?![^ ])")
            self.rules.append((text, label, errors, pattern))
            for a, b in zip(cuts, cuts[1:]):
                if a < b:  # a notice shorter than its pieces is searched for in any text
                    seeds.setdefault(text[a:b], []).append((n, a))
        self.automaton = ahocorasick.Automaton()
        for seed, at in seeds.items():
            self.automaton.add_word(seed, (len(seed), at))
        if seeds:
            self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """``(label, start, end, errors, length)`` in characters of the normalised text, one per place."""
        hits: dict[int, list[tuple[int, int]]] = {}
        for end, (size, at) in self.automaton.iter(text) if self.rules else ():
            for n, offset in at:
                hits.setdefault(n, []).append((end - size + 1 - offset, offset))
        found = []
        for n, places in hits.items():
            if len(places) < 2:
                continue
            rule, label, errors, pattern = self.rules[n]
            for low, high in self._regions(sorted(places), errors, len(rule)):
                low, high = max(0, low - errors - 1), min(len(text), high + len(rule) + errors + 1)
                found += [(label, m.start(), m.end(), sum(m.fuzzy_counts), len(rule)) for m in _best(pattern, text, low, high, len(rule) - errors)]
        return sorted(found, key=lambda x: (x[1], x[2], x[0]))

    @staticmethod
    def _regions(places: list[tuple[int, int]], errors: int, size: int) -> list[list[int]]:
        """Ranges of starts the notice would have where two different pieces agree within the errors."""
        regions: list[list[int]] = []
        first = 0
        for i, (begin, offset) in enumerate(places):
            while begin - places[first][0] > errors:
                first += 1
            if any(other != offset for _, other in places[first:i]):
                low = places[first][0]
                if regions and low - errors - 1 <= regions[-1][1] + size + errors + 1:
                    regions[-1][1] = begin
                else:
                    regions.append([low, begin])
        return regions


def _best(pattern, text: str, low: int, high: int, least: int) -> list:
    """The best match of a range, and those of what lies before and behind it."""
    out, todo = [], [(low, high)]
    while todo:
        a, b = todo.pop()
        match = pattern.search(text, a, b) if b - a >= least else None
        if match:
            out.append(match)
            todo += [(a, match.start() - 1), (match.end(), b)]
    return out


@lru_cache(maxsize=4)
def _notices(items: tuple[tuple[str, str], ...], per_error: int) -> Notices:
    return Notices(dict(items), per_error)


def phrase_places(words: list[str], phrases: dict[str, str]) -> list[tuple[str, int]]:
    """``(label, first word)`` of every place where a phrase's words stand one after another."""
    out = []
    for phrase, label in phrases.items():
        parts = phrase.split()
        at = -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                out.append((label, at))
    return sorted(out, key=lambda x: (x[1], x[0]))


def _scan(phrases: dict[str, str], notices: dict[str, str], per_error: int):
    last = {p: p.split()[-1].encode() for p in phrases}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _notices(tuple(notices.items()), per_error)
        for piece in pieces(batches, "text"):
            rows = []
            for i, raw in zip(piece.column("id").to_pylist(), piece.column("text").to_pylist()):
                words = (raw or b"").translate(FOLD).split()
                flat = b" ".join(words)
                some = {p: label for p, label in phrases.items() if last[p] in flat}
                text = flat.decode("utf-8", "replace")
                base = phrase_places(text.split(" "), some) if some else []
                spans = []
                seen = first = 0
                for label, a, b, errors, length in find.spans(text):
                    first, seen = first + text.count(" ", seen, a), a
                    end = first + text.count(" ", a, b) + 1
                    spans.append({"label": label, "start": first, "end": end, "errors": errors, "length": length})
                rows.append((i, len(words), [{"label": x, "word": w} for x, w in base], spans))
            kinds = (
                pa.string(), pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())])),
                pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int32()), ("length", pa.int32())])),
            )
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["id", "n_words", "base", "spans"])

    return scan


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, per_error: int = 8
) -> DataFrame:
    """``(id, n_words, base, spans, score)``: phrase places, verified notices in words ``[start, end)``, and the
    share of unchanged characters of the best notice (1 for a phrase)."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(_scan(phrases, notices, per_error), SCHEMA).withColumn("id", F.col("id").cast(kind))
    best = F.array_max(F.transform("spans", lambda s: 1 - s["errors"] / s["length"].cast("double")))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0)))
    return found.withColumn("score", score)


def op7_license_scan(spark, folder):
    rows = license_scan(table(spark, folder, "documents"))
    at = F.transform("base", lambda b: b["word"])
    own = F.transform("base", lambda b: b["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"), joined(own).alias("base_labels"),
        joined(F.concat(own, F.transform("spans", lambda s: s["label"]))).alias("labels"), "score",
    )


QUERIES = {"op7_license_scan": op7_license_scan}
SQL: dict[str, str] = {}
