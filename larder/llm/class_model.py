"""Scoring of texts with a Brown class-based bigram model.

Words belong to classes; a word's probability is that of its class after the class before it, times that of the
word in its class: ``P(w | v) = P(c(w) | c(v)) * P(w | c(w))``, both with added counts, so every word of every text has a
probability and the perplexity is finite. Counts of words come from all training texts: each task adds up its own and one
shuffle adds those. The ``clustered`` most frequent words start the ``classes`` classes by exchange clustering: a
word moves to the class that raises the likelihood of the class bigrams most, until few move. Their bigram counts, one table of
at most (clustered + 2) squared entries, pass the driver. Then every other training word, whatever its count, goes by the same
measure into the class that gains most from the classes found before and after it in all training texts; these counts are
shuffled by word. The class bigrams are counted again with all words in their classes. Words without training counts
share one class more, the text's end has its own.

Texts are read with the ``known`` most frequent words (a bounded table, sent to the tasks). Any other word goes out as (row, place,
word) with the classes beside it and is joined with the full table of words, so all counts and classes are exact whatever
the size of the vocabulary.

Defined results: a null text is empty and consists of its end alone. A null id is never held out. Equal rows score equally.
Without training texts every word is unknown. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.arrays import flat, pieces, runs
from larder.llm.common import prepare, table
from larder.session import staged

COUNTED = "word binary, n bigint"
CONTEXTS = "word binary, beside array<bigint>"
PLACED = "word binary, n bigint, c int"
READ = (
    "row bigint, id string, flag boolean, n_tokens bigint, n_known bigint, base double, score double, pairs binary, "
    "word binary, place bigint, before int, after int"
)


def _count_words(flush: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def table_() -> Iterator[pa.RecordBatch]:
            items = list(total.items())
            total.clear()
            for k in range(0, len(items), 50_000):
                words, n = zip(*items[k : k + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["word", "n"])

        for piece in pieces(batches, "text"):
            for text in piece.column("text").to_pylist():
                total.update((text or b"").lower().split())
            if len(total) > flush:
                yield from table_()
        yield from table_()

    return count


def _count_pairs(index: dict[bytes, int]):
    """Bigram counts over word numbers; the number past the words is any other word, the next one the end of a text."""
    other, end = len(index), len(index) + 1
    wide = end + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(wide * wide, np.int64)
        get = index.get
        for piece in pieces(batches, "text"):
            numbers = []
            for text in piece.column("text").to_pylist():
                numbers.append(end)
                numbers += [get(w, other) for w in (text or b"").lower().split()]
            numbers.append(end)
            x = np.array(numbers, np.int64)
            total += np.bincount(x[:-1] * wide + x[1:], minlength=wide * wide)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    return count


def _count_contexts(index: dict[bytes, int], own: np.ndarray, flush: int):
    """Of each word outside ``index``: how often each class stands before and after it, as ``times * 2k + side * k + class``."""
    k = int(own.max()) + 1
    first = len(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, found, held = dict(index), [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            return codes, np.bincount(at, weights=np.concatenate([n for _, n in found])).astype(np.int64)

        def table_() -> Iterator[pa.RecordBatch]:
            words = list(number)[first:]
            codes, n = added()
            word, beside = codes // (2 * k), n * (2 * k) + codes % (2 * k)
            for a in range(0, len(words), 50_000):
                names = words[a : a + 50_000]
                edges = np.searchsorted(word, np.arange(a, a + len(names) + 1))
                lists = pa.ListArray.from_arrays(pa.array(edges - edges[0], pa.int32()), pa.array(beside[edges[0] : edges[-1]]))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), lists], names=["word", "beside"])

        for piece in pieces(batches, "text"):
            numbers = [-1]
            for text in piece.column("text").to_pylist():
                numbers += [number.setdefault(w, len(number)) for w in (text or b"").lower().split()]
                numbers.append(-1)
            x = np.array(numbers, np.int64)
            c = own[np.where(x < 0, first + 1, np.minimum(x, first))]
            at = np.flatnonzero(x >= first)
            if not len(at):
                continue
            codes = np.concatenate([(x[at] - first) * (2 * k) + c[at - 1], (x[at] - first) * (2 * k) + k + c[at + 1]])
            found.append(np.unique(codes, return_counts=True))
            held += len(found[-1][0])
            if held > 8 * flush:
                found[:] = [added()]
                held = len(found[0][0])
            if len(number) - first > flush or held > 4 * flush and len(found) == 1:
                yield from table_()
                number, held = dict(index), 0
                found.clear()
        if found:
            yield from table_()

    return count


def _place(bigrams: np.ndarray):
    """Class of each word by what its neighbours' classes, which stay, gain from it; the last two classes take none. Rows come by word."""
    k = len(bigrams)
    t = bigrams.astype(np.float64)
    sides = np.concatenate([t[:, : k - 2], t.T[:, : k - 2]])  # by slot: how often each class comes after, then before, that class
    left, right = t.sum(axis=1)[: k - 2], t.sum(axis=0)[: k - 2]

    def chosen(words: pa.Array, beside: np.ndarray) -> pa.RecordBatch:
        n = beside[:, :k].sum(axis=1)
        word, slot = np.nonzero(beside)
        times = beside[word, slot][:, None]
        each = _plogp(sides[slot] + times) - _plogp(sides[slot])
        gain = np.add.reduceat(each, runs(word)[:-1], axis=0)
        gain -= _plogp(left + n[:, None]) - _plogp(left) + _plogp(right + n[:, None]) - _plogp(right)
        c = pa.array(np.argmax(gain, axis=1).astype(np.int32))
        return pa.RecordBatch.from_arrays([words, pa.array(n.astype(np.int64)), c], names=["word", "n", "c"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, open_ = None, np.zeros(2 * k)  # a word may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, coded = batch.column("beside"), batch.column("word").dictionary_encode()
            words, numbers = coded.dictionary, np.asarray(coded.indices, np.int64)
            values, owner = np.asarray(lists.flatten(), np.int64), np.repeat(numbers, np.asarray(lists.value_lengths(), np.int64))
            beside = np.bincount(owner * (2 * k) + values % (2 * k), weights=values // (2 * k), minlength=len(words) * 2 * k).reshape(-1, 2 * k)
            if last is not None and words[0].as_py() == last:
                beside[0] += open_
            elif last is not None:
                yield chosen(pa.array([last], pa.binary()), open_[None, :])
            last, open_ = words[-1].as_py(), beside[-1]
            if len(words) > 1:
                yield chosen(words[:-1], beside[:-1])
        if last is not None:
            yield chosen(pa.array([last], pa.binary()), open_[None, :])

    return place


def _plogp(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(pairs: np.ndarray, classes: int, rounds: int = 6) -> np.ndarray:
    """Class of each word by exchange clustering of a square bigram table.

    The last two rows are the other words and the end of text, which keep classes of their own. The likelihood
    is the sum of n log n over class bigrams less that over the classes on either side; row and column
    sums of the classes move with a word, so a move changes two rows and two columns.
    """
    v = len(pairs) - 2
    k = min(classes, max(v, 1)) + 2
    own = np.append(np.arange(v) % max(k - 2, 1), [k - 2, k - 1])
    n = pairs.astype(np.float64)
    rows = np.zeros((k, len(pairs)))
    np.add.at(rows, own, n)
    table_ = np.zeros((k, k))
    np.add.at(table_.T, own, rows.T)
    cols = np.zeros((len(pairs), k))
    np.add.at(cols.T, own, n.T)
    left, right = n.sum(axis=1), n.sum(axis=0)
    for _ in range(rounds):
        moved = 0
        for w in range(v):
            a = own[w]
            out, into, self_ = cols[w].copy(), rows[:, w].copy(), n[w, w]
            out[a] -= self_  # counts with classes after w and before w, w itself apart
            into[a] -= self_
            base = table_.copy()
            base[a] -= out
            base[:, a] -= into
            base[a, a] -= self_
            lsum, rsum = base.sum(axis=1), base.sum(axis=0)
            # Gain of adding w to each class b: rows b, columns b and their crossing change.
            gain = (_plogp(base + out[None, :]) - _plogp(base)).sum(axis=1) + (_plogp(base + into[:, None]) - _plogp(base)).sum(axis=0)
            d, o, i = np.diag(base), out, into
            gain += _plogp(d + o + i + self_) - _plogp(d + o) - _plogp(d + i) + _plogp(d)
            gain -= _plogp(lsum + left[w]) - _plogp(lsum) + _plogp(rsum + right[w]) - _plogp(rsum)
            b = int(np.argmax(gain[: k - 2]))
            if b != a and gain[b] > gain[a] + 1e-9:
                base[b] += out
                base[:, b] += into
                base[b, b] += self_
                table_ = base
                rows[a] -= n[w]
                rows[b] += n[w]
                cols[:, a] -= n[:, w]
                cols[:, b] += n[:, w]
                own[w] = b
                moved += 1
        if moved <= v // 100:
            break
    return own


class ClassModel:
    """``words`` numbers the known words, whose classes are ``classes`` and counts ``counts``; ``step[c, d]`` is log10 P(d | c)."""

    def __init__(self, top, size, other, end, train, distinct, ends, complete):
        self.words = {w: i for i, w in enumerate(top.column("word").to_pylist())}
        self.classes, self.counts = np.asarray(top.column("c"), np.int64), np.asarray(top.column("n"), np.int64)
        self.size, self.other, self.end = size, other, end
        self.train, self.distinct, self.ends, self.complete = train, distinct, ends, complete
        self.step = np.zeros((len(size), len(size)))

    def learn(self, bigrams: np.ndarray) -> None:
        """Step from one class to the next; after words without counts the classes come as often as anywhere."""
        table_ = bigrams.astype(np.float64)
        table_[self.other] = table_.sum(axis=0)
        k = len(table_)
        self.step = np.log10((table_ + 0.5) / (table_.sum(axis=1, keepdims=True) + 0.5 * k))

    def emission(self, n, c):
        """log10 probability of words of counts n in their classes; unknown words share one added count."""
        return np.log10((n + 1) / self.size[c])

    def base(self, n):
        return np.log10((n + 1) / (self.train + self.distinct + 1))


def fit_classes(texts: DataFrame, clustered: int = 600, classes: int = 24, known: int = 200_000, flush: int = 400_000) -> tuple[ClassModel, DataFrame]:
    """The model, still without steps, and the table of all words ``(word, n, c)``, c their class, from ``texts (text binary)``."""
    spark = texts.sparkSession
    prepare(spark)
    counts = texts.select("text").mapInArrow(_count_words(flush), COUNTED).groupBy("word").agg(F.sum("n").alias("n"))
    counts = staged(counts, "word-counts")
    docs = texts.count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("n"), "word").limit(clustered).collect()
    index = {bytes(r["word"]): i for i, r in enumerate(sorted(top, key=lambda r: (-r["n"], bytes(r["word"]))))}
    wide = len(index) + 2
    matrix = _square(texts.select("text").mapInArrow(_count_pairs(index), "pair bigint, n bigint"), wide)
    own = exchange(matrix, classes)
    k = int(own.max()) + 1
    start = np.zeros((k, k), np.int64)
    np.add.at(start, (own[:, None], own[None, :]), matrix)
    other, end = int(own[-2]), int(own[-1])
    beside = texts.select("text").mapInArrow(_count_contexts(index, own, flush), CONTEXTS)
    beside = beside.repartition("word").sortWithinPartitions("word")
    first = spark.createDataFrame([(r["word"], r["n"], int(own[index[bytes(r["word"])]])) for r in top], PLACED)
    words = staged(beside.mapInArrow(_place(start), PLACED).union(first), "word-classes")
    members, sums = np.zeros(k), np.zeros(k)
    for r in words.groupBy("c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m")).collect():
        members[r["c"]], sums[r["c"]] = r["m"], r["n"]
    members[other], sums[end] = 1, docs
    size = np.maximum(sums + members, 1.0)
    size[end] = docs + 1
    top = words.orderBy(F.desc("n"), "word").limit(known).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    model = ClassModel(top, size, other, end, total + docs, distinct + (1 if docs else 0), docs, distinct <= top.num_rows)
    return model, words


def train(texts: DataFrame, **options) -> tuple[ClassModel, DataFrame]:
    """The model and the table of all words ``(word, n, c)`` from ``texts (text binary)``; options as of ``fit_classes``."""
    model, words = fit_classes(texts, **options)
    rows = texts.select(F.lit(None).cast("string").alias("id"), F.lit(False).alias("flag"), "text")
    model.learn(_class_bigrams(*read_texts(rows, model, words), model))
    return model, words


def _square(pairs: DataFrame, wide: int) -> np.ndarray:
    found = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros(wide * wide, np.int64)
    matrix[np.asarray(found.column("pair"), np.int64)] = np.asarray(found.column("n"), np.int64)
    return matrix.reshape(wide, wide)


def _read(shared):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: ClassModel = shared.value
        k, first, get = len(m.size), len(m.words), m.words.get
        # By word number; the last entry is any word outside the table, -1 the class that the full table has to tell.
        c = np.append(m.classes, m.other if m.complete else -1)
        e = np.append(m.emission(m.counts, m.classes), m.emission(0, m.other) if m.complete else 0.0)
        b = np.append(m.base(m.counts), m.base(0) if m.complete else 0.0)
        end_base, end_known, end_emission = m.base(m.ends), int(m.ends > 0), m.emission(m.ends, m.end)
        names = [f.split()[0] for f in READ.split(", ")]
        for piece in pieces(batches, "text"):
            extra: dict[bytes, int] = {}
            rows, outside = [], []
            for text, row, i, flag in zip(*(piece.column(n).to_pylist() for n in ("text", "row", "id", "flag"))):
                words = (text or b"").lower().split()
                x = np.array([extra.setdefault(w, first + len(extra)) if (n := get(w)) is None else n for w in words], np.int64)
                at = np.minimum(x, first)
                path = np.concatenate([[m.end], c[at], [m.end]])
                sure = (path[:-1] >= 0) & (path[1:] >= 0)
                pairs = (path[:-1] * k + path[1:])[sure].astype("<u4").tobytes()
                rows.append((row, i, flag, len(x) + 1, int((x < first).sum()) + end_known, float(b[at].sum() + end_base), float(e[at].sum() + end_emission), pairs))
                if not sure.all():
                    open_ = np.flatnonzero(path < 0)
                    outside.append((np.full(len(open_), row), np.full(len(open_), flag), x[open_ - 1] - first, open_, path[open_ - 1], path[open_ + 1]))
            kinds = (pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
            none = [pa.nulls(len(rows), t) for t in (pa.binary(), pa.int64(), pa.int32(), pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)] + none, names=names)
            if outside:
                row, flag, word, place, before, after = (np.concatenate(v) for v in zip(*outside))
                none = {n: pa.nulls(len(row), t) for n, t in zip(names, kinds)}
                none |= {"row": pa.array(row), "flag": pa.array(flag), "word": pa.array(list(extra), pa.binary()).take(pa.array(word)), "place": pa.array(place)}
                none |= {"before": pa.array(before.astype(np.int32)), "after": pa.array(after.astype(np.int32))}
                yield pa.RecordBatch.from_arrays([none[n] for n in names], names=names)

    return read


def read_texts(rows: DataFrame, model: ClassModel, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(lines, places)`` of ``rows (id string, flag boolean, text binary)``, stored.

    A line has the sums over the known words of a text and its ``pairs`` of classes. ``places (row, flag, n, c, before, after)``
    are words outside the known ones with the classes beside them; of two such words in a row the first one has their pair.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    keyed = rows.select(F.monotonically_increasing_id().alias("row"), "id", "flag", "text")
    read = staged(keyed.mapInArrow(_read(shared), READ), "read-texts")
    places = read.filter("word is not null").select("row", "flag", "word", "place", "before", "after")
    lines = read.filter("word is null").drop("word", "place", "before", "after")
    places = places.join(words, "word", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "c": F.coalesce("c", F.lit(model.other))})
    follows = F.lead("c").over(Window.partitionBy("row").orderBy("place"))
    before, after = F.when(F.col("before") >= 0, F.col("before")), F.when(F.col("after") >= 0, F.col("after")).otherwise(follows)
    places = places.select("row", "flag", "n", "c", before.alias("before"), after.alias("after"))
    return lines, places if model.complete else staged(places, "read-places")


def _count_codes(width: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(flat(batch.column("pairs"))[0].copy().view("<u4"), minlength=width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    return count


def _class_bigrams(lines: DataFrame, places: DataFrame, model: ClassModel) -> np.ndarray:
    """Class bigrams of the rows without flag, every word in its class."""
    k = len(model.size)
    found = lines.filter("not flag").select("pairs").mapInArrow(_count_codes(k * k), "pair bigint, n bigint")
    pairs = F.array(F.col("before") * k + F.col("c"), F.col("c") * k + F.col("after")).cast("array<bigint>")
    rest = places.filter("not flag").select(F.explode(pairs).alias("pair"), F.lit(1).cast("bigint").alias("n")).filter("pair is not null")
    return _square(found if model.complete else found.union(rest), k)


def _add_steps(step: np.ndarray):
    """Add the steps of its pairs to the score of each row."""
    steps = step.ravel()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("pairs"))
            sums = np.concatenate([[0.0], np.cumsum(steps[data.copy().view("<u4")])])[offsets // 4]
            score = pa.array(np.asarray(batch.column("score")) + np.diff(sums))
            yield batch.drop_columns(["pairs", "score"]).append_column("score", score)

    return add


def _scored(lines: DataFrame, places: DataFrame, model: ClassModel) -> DataFrame:
    made = lines.mapInArrow(_add_steps(model.step), "row bigint, id string, flag boolean, n_tokens bigint, n_known bigint, base double, score double")
    if not model.complete:
        n, c, k = F.col("n"), F.col("c"), len(model.size)
        step, size = F.lit(model.step.ravel().tolist()), F.lit(model.size.tolist())
        into, on = F.get(step, F.col("before") * k + c), F.get(step, c * k + F.col("after"))
        rest = places.groupBy("row").agg(
            F.sum((n > 0).cast("int")).alias("more"), F.sum(F.log10((n + 1) / F.lit(float(model.train + model.distinct + 1)))).alias("b2"),
            F.sum(F.log10((n + 1) / F.get(size, c)) + F.coalesce(into, F.lit(0.0)) + F.coalesce(on, F.lit(0.0))).alias("s2"),
        )
        made = made.join(rest, "row", "left")
    else:
        made = made.withColumns({"more": F.lit(0), "b2": F.lit(0.0), "s2": F.lit(0.0)})
    value = F.col("score") + F.coalesce("s2", F.lit(0.0))
    return made.select(
        "id", "flag", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("bigint").alias("n_known"),
        (F.col("base") + F.coalesce("b2", F.lit(0.0))).alias("base_score"), value.alias("score"),
        F.pow(F.lit(10.0), -value / F.col("n_tokens")).alias("perplexity"),
    )


def score_texts(rows: DataFrame, model: ClassModel, words: DataFrame) -> DataFrame:
    """``(id, flag, n_tokens, n_known, base_score, score, perplexity)`` for ``rows (id string, flag, text binary)``."""
    return _scored(*read_texts(rows, model, words), model)


def train_and_score(rows: DataFrame) -> tuple[ClassModel, DataFrame]:
    """``train`` on the rows without flag and ``score_texts`` of all rows, which are read with their classes once for both."""
    model, words = fit_classes(rows.filter(~F.col("flag")))
    lines, places = read_texts(rows, model, words)
    model.learn(_class_bigrams(lines, places, model))
    return model, _scored(lines, places, model)


def op4_class_model(spark, folder):
    docs = table(spark, folder, "documents")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), out.alias("flag"), F.col("text").cast("binary").alias("text"))
    model, scored = train_and_score(rows)
    return scored.select(
        F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("flag").alias("held_out"), "n_tokens", "n_known",
        F.lit(int(model.train)).cast("bigint").alias("train_tokens"), "base_score", "score", "perplexity",
    )


QUERIES = {"op4_class_model": op4_class_model}
SQL: dict[str, str] = {}
