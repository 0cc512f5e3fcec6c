"""Records of JSON files read in blocks, and the table of what could not be read."""

from __future__ import annotations

import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.sources import records, scan


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 5)
    if kind == 1:
        return "".join(rng.choice('ab,{}[]"\\\n\té: ') for _ in range(rng.randint(0, 12)))
    if kind == 5:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    if kind == 6:
        return {rng.choice("abc,]"): value(rng, depth + 1) for _ in range(rng.randint(0, 4))}
    return [rng.randint(-99, 99), None, None, rng.random(), "x," * rng.randint(0, 9)][kind]


def array_text(rng, items):
    style = rng.randrange(4)
    if style < 2:
        return json.dumps(items, indent=[None, rng.choice([0, 2])][style], ensure_ascii=False)
    if style == 2:
        return "[\n" + ",\n".join(map(json.dumps, items)) + "\n]\n"
    return "  [ " + " , ".join(json.dumps(x, separators=(",", ":")) for x in items) + " ]  "


@pytest.fixture
def block_size(spark):
    """Sets the size of the blocks files are read in."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def set_size(size: str) -> None:
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "1b")

    yield set_size
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def by_file(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["pos"]):
        out.setdefault(r["file"].rsplit("/", 1)[1], []).append(r)
    return out


@pytest.mark.parametrize("size,sent", [("300b", 10**6), ("2k", 0), ("1m", 10**6)])
def test_arrays_in_blocks_equal_the_whole(spark, tmp_path, block_size, size, sent):
    rng, want = random.Random(len(size) + sent), {}
    for i in range(6):
        items = [{"id": j, "v": value(rng)} if rng.random() < 0.8 else value(rng) for j in range([0, 1, 3, 40, 150, 300][i])]
        text = array_text(rng, items)
        (tmp_path / f"f{i}.json").write_text(text, encoding="utf-8")
        want[f"f{i}.json"] = (text.encode(), items)
    single = {"id": 1, "v": [value(rng) for _ in range(200)]}
    (tmp_path / "single.json").write_text(json.dumps(single))
    want["single.json"] = (json.dumps(single).encode(), [single])
    block_size(size)
    rows = records.json_elements(spark, str(tmp_path), "*.json", sent).collect()
    got = by_file(rows)
    assert all(r["reason"] is None for r in rows)
    for name, (text, items) in want.items():
        mine = got.get(name, [])
        assert [json.loads(r["value"]) for r in mine] == items and [r["pos"] for r in mine] == list(range(len(items)))
        for r in mine:
            assert text[r["at"] :].startswith(r["value"].strip().encode())
    if size == "300b":
        assert len({(r["file"], r["block"]) for r in rows}) > 20


def test_structure_against_a_walk():
    rng = random.Random(7)
    for _ in range(3000):
        text = bytes(rng.choice(b'"\\\n,[]{}a') for _ in range(rng.randint(1, 25)))
        string, depth = rng.randrange(2), rng.randrange(3)
        outside, after, last = records.structure(np.frombuffer(text, np.uint8), string, depth)
        escaped = False
        for i, c in enumerate(text):
            mark = c == ord('"') and not escaped
            assert bool(outside[i]) == (not string and not mark)
            depth += int(records.STEP[c]) if not string else 0
            string = 0 if c == ord("\n") else string ^ mark
            escaped = c == ord("\\") and not escaped
            assert after[i] == depth
        assert last == string


@pytest.mark.parametrize("size", ["64b", "1m"])
def test_bad_records_do_not_take_others_along(spark, tmp_path, block_size, size):
    block_size(size)
    files = {
        "quote.json": '[{"id": "a"},\n{"id": "b, "x": 1},\n{"id": "c"}]',  # an unclosed quote spoils its line
        "brace.json": "[\n" + "".join(f'{{"id": "n{i}"}},\n' for i in range(20)) + '{"id": "lost", "x": [1},\n{"id": "d"},\n{"id": "e"}\n]\n',
        "first.json": '[{"id": "lost", "x": {"y": 1},\n{"id": "s"},\n{"id": "t"}]',
        "cut.json": '[{"id": "f"}, {"id": "g", "text": "and so on',
        "compact.json": '[{"id":"h"},{"id":"i"},{"id":{"j":1},{"id":"k"},{"id":"l"}]',
        "odd.json": '[{"id": "o"}, 5, , [1], {"id": "p"},] tail',
        "open.json": '[{"id": "q"}, {"id": "r"}',
        "empty.json": " \n ", "none.json": "[ ]", "scalar.json": "7", "bad.json": "{oops",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    ids = sorted(r["id"] for r in scan.scan_documents(spark, str(tmp_path)).collect())
    assert ids == sorted(["a", "c", *[f"n{i}" for i in range(20)], "d", "e", "f", "h", "i", "o", "p", "q", "r", "s", "t"])
    lost = {}
    for r in scan.quarantine(spark, str(tmp_path)).collect():
        name = r["file"].rsplit("/", 1)[1]
        lost.setdefault(name, []).append((r["reason"], files[name][r["at"] :][:4]))
    assert {n: sorted(x) for n, x in lost.items()} == {
        "quote.json": [("not JSON", '{"id')], "brace.json": [("not JSON", '{"id')], "first.json": [("not JSON", '{"id')], "cut.json": [("unclosed", '{"id')],
        "compact.json": [("unclosed", '{"id')], "scalar.json": [("not an object", "7")], "bad.json": [("not JSON", "{oop")],
        "odd.json": [("empty element", ", [1"), ("empty element", "] ta"), ("not an object", "5, ,"), ("not an object", "[1],"), ("outside the root", "tail")],
    }


@pytest.mark.parametrize("size", ["50b", "1m"])
def test_lines_and_lists(spark, tmp_path, block_size, size):
    block_size(size)
    lines = ['{"id": "1"}', "", "  {bad", '[{"id": "2"}, 5, {"id": "3"}, [6]]', "7", '{"id": "é"}\r', '"text"', "[]", "{}", '{"id": "9"'] * 3
    (tmp_path / "a.jsonl").write_bytes("\n".join(lines).encode())
    for name in ("b.ndjson.gz", "c.json.gz"):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write('{"id": "4"}\n' if name[0] == "b" else '[{"id": "5"}, 6]')
    rows = scan.scan_documents(spark, str(tmp_path))
    assert sorted(r["id"] or "" for r in rows.collect()) == sorted(["1", "2", "3", "é", ""] * 3 + ["4", "5"])
    order = rows.filter(F.col("file").endswith("a.jsonl")).orderBy("block", "pos", "item").collect()
    assert [r["id"] for r in order] == ["1", "2", "3", "é", None] * 3
    text = "\n".join(lines).encode()
    bad = scan.quarantine(spark, str(tmp_path)).collect()
    mine = sorted((r["at"], r["item"], r["reason"], r["sample"]) for r in bad if r["file"].endswith("a.jsonl"))
    want, at = [], 0
    for line in lines:
        lead = len(line) - len(line.lstrip())
        for item, reason, sample in {
            "  {bad": [(0, "not JSON", "{bad")], lines[3]: [(1, "not an object", "5"), (3, "not an object", "[6]")], "7": [(0, "not an object", "7")],
            '"text"': [(0, "not an object", '"text"')], '{"id": "9"': [(0, "not JSON", '{"id": "9"')],
        }.get(line, []):
            want.append((at + lead, item, reason, sample))
        at += len(line.encode()) + 1
    assert mine == want and all(text[a:].startswith(s.encode()) for a, i, _, s in mine if i == 0)
    assert [r["sample"] for r in bad if not r["file"].endswith("a.jsonl")] == ["6"]
