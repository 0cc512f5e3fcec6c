"""Fill-in-the-middle, periodic runs and packing against brute force."""

from __future__ import annotations

import bisect
import json
import random
import zlib
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from larder.llm import fill_middle, packing, periodic_runs

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_piece_table_cuts_permutes_and_restores():
    marks = {p: s.encode() for p, s in fill_middle.SENTINELS.items()}
    text = "één twee drie vier".encode()
    for form in fill_middle.FORMS:
        for low in range(len(text) + 1):
            for high in range(low, len(text) + 1):
                made = fill_middle.arrange(text, low, high, form, marks)
                parts = {"prefix": text[:low], "middle": text[low:high], "suffix": text[high:]}
                want = b"".join(marks[p] + parts[p] for p in fill_middle.FORMS[form])
                assert made.text() == want and made.digest() == sha256(want).hexdigest()
                assert fill_middle.restore(want, form, marks).text() == text
    twice = fill_middle.PieceTable.whole(b"abcdef").cut([2, 4]).permuted([2, 0, 1]).cut([1, 1, 3, 6])
    assert twice.text() == b"efabcd" and [d.end - d.start for d in twice.descriptors] == [1, 0, 1, 1, 1, 2, 0]


def test_sentinels_that_overlap_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    for bad in ("", "<P>", "x<P>x", "><"):
        with pytest.raises(ValueError):
            fill_middle.fill_middle(docs, sentinels=fill_middle.SENTINELS | {"suffix": bad})


def test_fill_middle_by_hand(spark):
    texts = ["a  b\tc ", "ohne ümlaut und\nmit é  ", "has <S> inside", "   ", "x"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = fill_middle.restored(fill_middle.fill_middle(docs)).orderBy("id").collect()
    seen = set()
    for r, text in zip(rows, texts):
        digest = sha256(f"42:{r['id']}".encode()).hexdigest()
        h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
        units = [u for u in __import__("re").findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)]
        low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
        form = "plain" if "<S>" in text or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
        want = {"plain": text, "psm": f"<P>{a}<S>{c}<M>{b}", "spm": f"<S>{c}<P>{a}<M>{b}"}[form]
        assert (r["n"], r["form"], r["output"], r["text"]) == (len(units), form, want, text)
        assert (r["prefix_chars"], r["middle_chars"]) == ((None, None) if form == "plain" else (len(a), len(b)))
        assert r["output_sha256"] == sha256(want.encode()).hexdigest() and r["restored_sha256"] == sha256(text.encode()).hexdigest()
        seen.add(form)
    assert seen == {"plain", "psm", "spm"}


def lyndon(t):
    out = []
    for i in range(len(t)):
        best = 1
        for j in range(i + 1, len(t) + 1):
            w = t[i:j]
            if all(w < w[k:] for k in range(1, len(w))):
                best = j - i
        out.append(best)
    return out


def all_runs(t, exponent, shortest):
    out = set()
    for q in range(1, len(t) // exponent + 1):
        i = 0
        while i < len(t) - q:
            j = i
            while j < len(t) - q and t[j] == t[j + q]:
                j += 1
            length = j - i + q
            if length >= max(exponent * q, shortest) and not any((i, length, x) in out for x in range(1, q)):
                out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive_words(rng):
    letters = rng.randint(1, 4)
    t = [rng.randrange(letters) for _ in range(rng.randint(1, 24))]
    if rng.random() < 0.5:
        t = (t[: rng.randint(0, 6)] + t[: rng.randint(1, 4)] * rng.randint(2, 6) + t)[:40]
    return t


def test_lyndon_arrays_and_runs():
    rng = random.Random(3)
    for _ in range(600):
        t = repetitive_words(rng)
        assert periodic_runs.lyndon_array(np.array(t)).tolist() == lyndon(t)
        assert periodic_runs.lyndon_array(np.array(t), reverse=True).tolist() == lyndon([-x for x in t])
        for exponent, shortest in ((2, 2), (3, 5), (4, 6)):
            assert periodic_runs.runs(np.array(t), exponent, shortest) == all_runs(t, exponent, shortest)


def test_periodic_runs_of_rows(spark):
    rng = random.Random(5)
    words = [repetitive_words(rng) + [9] * rng.randint(0, 1) + repetitive_words(rng) for _ in range(120)]
    docs = spark.createDataFrame([(i, " \n".join(f"w{x}" for x in w)) for i, w in enumerate(words)], "doc_id bigint, text string")
    for exponent, shortest in ((2, 2), (4, 6)):
        for r in periodic_runs.periodic_runs(docs, exponent=exponent, shortest=shortest).collect():
            w = words[r["id"]]
            want = all_runs(w, exponent, shortest)
            gone = {i for s, n, p in want for i in range(s + p, s + n)}
            assert [tuple(x) for x in r["runs"]] == want and r["n_words"] == len(w)
            assert r["collapsed"] == " ".join(f"w{x}" for i, x in enumerate(w) if i not in gone)


def test_runs_of_long_texts_take_linear_time():
    assert periodic_runs.runs(np.zeros(300_000, np.int64), 4, 6) == [(0, 300_000, 1)]
    assert periodic_runs.runs(np.arange(300_000) % 1000, 4, 6) == [(0, 300_000, 1000)]


def one_by_one(counts, capacity):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            k = bisect.bisect_left(rooms, length)
            room = rooms.pop(k) if k < len(rooms) else capacity
            bisect.insort(rooms, room - length)
    return rooms


def test_best_fit_equals_piece_by_piece():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([5, 10, 37, 100])
        counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(1, 20))}
        plan = np.array(sorted(packing.best_fit(counts, capacity)), np.int64)
        batch = pa.RecordBatch.from_pydict({
            "length": [n for n in counts for _ in range(counts[n])], "rank": [i for n in counts for i in range(counts[n])],
        })
        placed = next(packing._assign(plan)(iter([batch]))).to_pandas()
        fill = placed.groupby("sequence_id")["length"].sum()
        assert sorted(capacity - fill) == one_by_one(counts, capacity)
        for _, g in placed.sort_values("offset").groupby("sequence_id"):
            assert (g["offset"].values == np.cumsum(g["length"].values) - g["length"].values).all()


def test_tree_names_the_tightest_capacity():
    rng, tree, there = random.Random(2), packing.Capacities(100), set()
    for _ in range(2000):
        c = rng.randrange(101)
        (there.discard if c in there else there.add)(c)
        tree.mark(c, c in there)
        least = rng.randrange(101)
        assert tree.tightest(least) == min((x for x in there if x >= least), default=None)


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_tokens_of_units(path):
    """The word tokenizer's ids are those of whole texts; other rules go word by word."""
    tokenizer, units, rng = Tokenizer.from_file(path), packing.UnitIds(Path(path).read_text(encoding="utf-8"), most=500), random.Random(4)
    signs = "abcXYZÀÉ×÷ÿÞß \t\n\x0b'’éΣς̈́ İ  ​.,!?-_12½中文한한ﬁ\x00\x1c\x85🎉"
    for _ in range(1500):
        texts = ["".join(rng.choice([rng.choice(signs), rng.choice(["'s ", "don't", " the ", "<|endoftext|>"])]) for _ in range(rng.randint(0, 20))) for _ in range(3)]
        raw = [t.encode() for t in texts]
        ids, at = units.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        for i, text in enumerate(texts):
            if path == WORD_BPE:
                want = tokenizer.encode(text, add_special_tokens=False).ids
            else:
                want = [x for w in text.encode().split() for x in tokenizer.encode(w.decode(), add_special_tokens=False).ids]
            assert ids[at[i] : at[i + 1]].tolist() == want


def test_packing_of_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").repartition(5)
    cut = packing.token_pieces(docs, WORD_BPE, capacity=512)
    packed = packing.pack(cut, capacity=512)
    rows, tokenizer, want, counts = packed.collect(), Tokenizer.from_file(WORD_BPE), {}, {}
    for d in docs.collect():
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        for n, a in enumerate(range(0, len(ids), 512)):
            part = ids[a : a + 512]
            want[d["doc_id"], n] = (a, part, zlib.crc32(np.array(part, "<u4").tobytes()))
            counts[len(part)] = counts.get(len(part), 0) + 1
    assert {(r["id"], r["piece"]): (r["start"], r["ids"], r["ids_crc32"]) for r in rows} == want
    fill: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert fill.get(r["sequence_id"], 0) == r["offset"]
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(512 - x for x in fill.values()) == one_by_one(counts, 512)
    for s in packing.sequences(packed).collect():
        assert len(s["ids"]) == fill[s["sequence_id"]] and s["ids"] == [x for p in s["parts"] for x in want[p["id"], p["piece"]][1]]


def test_rule_of_the_tokenizer_file():
    splits = json.loads(Path(WORD_BPE).read_text(encoding="utf-8"))["pre_tokenizer"]["pretokenizers"]
    assert splits[0]["pattern"]["Regex"] == packing.RULE and packing.UnitIds(Path(WORD_BPE).read_text(encoding="utf-8")).splits
