"""Operators against brute force on small tables, and held-out accuracy."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import (
    class_model, decontaminate, graph, language_id, license_scan, line_dedup, mixing, ngram_join, quality_rules, sharding, substring_dedup,
)
from larder.llm.graph import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def texts_of(seed: int, n: int, vocabulary: int = 60, longest: int = 120) -> list[str]:
    """Random texts, many of them edited copies of earlier ones."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(words) + 1)
                words[k : k + rng.randint(0, 1)] = [f"v{rng.randrange(vocabulary)}"] * rng.randint(0, 1)
        else:
            words = [f"v{rng.randrange(vocabulary)}" for _ in range(rng.randint(1, longest))]
        out.append(" ".join(words))
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string")


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (1, 60)])
def test_ngram_join_components(spark, width, percent):
    texts = texts_of(width, 160)
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similarity_groups(frame(spark, texts), width=width, percent=percent)[0].collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def test_partition_finds_every_pair_within_the_threshold():
    rng = np.random.default_rng(1)
    for percent in (60, 80, 85, 95):
        plan = ngram_join.Partition(percent)
        for n in (1, 2, 3, 5, 8, 13, 30, 90, 400):
            for _ in range(12):
                a = rng.integers(0, 1 << 63, n).astype(np.uint64)
                most = int((100 - percent) * n / percent)
                drop, add = int(rng.integers(0, most + 1)), 0
                add = int(rng.integers(0, max(1, most - drop + 1)))
                b = np.concatenate([a[: n - drop], rng.integers(0, 1 << 63, add).astype(np.uint64)])
                if not len(b) or 100 * (n - drop) < percent * (n + add):
                    continue
                keys, who = plan.keys([a, b], np.array([len(a), len(b)]))
                assert set(keys[who == 0].tolist()) & set(keys[who == 1].tolist())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 201: 200}


@pytest.mark.parametrize("window,run", [(20, 8), (5, 3), (3, 3)])
def test_substring_dedup(spark, window, run):
    texts = texts_of(7, 120, vocabulary=25)
    seen, want = set(), {}
    for i, t in enumerate(texts):
        words = t.split()
        gone, own = set(), []
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                gone |= set(range(s, s + window))
            seen.add(w)
        own = [w for k, w in enumerate(words) if k not in gone]
        want[i] = (len(words), len(gone), " ".join(own))
    rows = substring_dedup.substring_dedup(frame(spark, texts), window=window, run=run, broadcast_bytes=0).collect()
    assert {r["id"]: (r["n_words"], r["n_removed"], r["text"]) for r in rows} == want
    assert all(sum(x["end"] - x["start"] for x in r["removed"]) == r["n_removed"] for r in rows)


@pytest.mark.parametrize("most", [0, 96 << 20])
def test_substring_dedup_keeps_one_copy_of_repeated_rows(spark, most):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    data = [(1, one), (1, one), (2, one), (3, two), (4, f"{two} c"), (4, f"{two} c"), (None, "n " * 30), (None, "n " * 30)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    rows = substring_dedup.substring_dedup(docs, broadcast_bytes=most).collect()
    got = sorted((r["id"] or 0, r["n_words"], r["n_removed"], r["text"]) for r in rows)
    assert got == [(0, 30, 29, "n")] * 2 + [(1, 60, 0, one)] * 2 + [(2, 60, 60, ""), (3, 60, 0, two)] + [(4, 61, 60, "c")] * 2


def test_decontaminate_in_blocks(spark):
    texts = [t.replace(" ", "-", 3) for t in texts_of(3, 60, vocabulary=12)]
    items = [(1, "V1 v2"), (2, texts[5]), (3, "v3"), (4, "nothing here"), (5, texts[9][:60])]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = {}
    for i, t in enumerate(texts):
        words, hit, found = word.findall(t.lower()), set(), set()
        for k, item in items:
            own = word.findall(item.lower())
            size = min(10, len(own))
            for j in range(max(1, len(own) - 9)):
                for s in range(len(words) - size + 1):
                    if words[s : s + size] == own[j : j + size]:
                        hit |= set(range(s, s + size))
                        found.add(str(k))
        want[i] = (len(words), len(hit), sorted(found))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.decontaminate(frame(spark, texts), benchmark, block=20)[0].collect()
    assert {r["id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in rows} == want


def test_line_bitmaps(spark):
    line, other = "this line is long enough to count", "another line that is long enough"
    texts = ["\n".join([f"own {i} line, never shared by others", *([line] * 70), "short", other.upper() + "  "]) for i in range(4)]
    rows = {r["id"]: r for r in line_dedup.line_dedup(frame(spark, texts)).withColumn("kept", line_dedup.kept_text(F.col("text"), F.col("keep"))).collect()}
    assert rows[3]["n_dropped"] == 0 and rows[3]["kept"] == texts[3]
    assert rows[0]["n_dropped"] == 71 and rows[0]["kept"] == "own 0 line, never shared by others\nshort"
    assert [x["word"] for x in rows[0]["keep"]] == [0, 1]


@pytest.mark.parametrize("known", [200_000, 30])
def test_class_model_counts(spark, folder, known):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), (F.col("doc_id") % 5 == 0).alias("flag"), F.col("text").cast("binary").alias("text"))
    tokens = {str(r["doc_id"]): r["text"].encode().lower().split() + [None] for r in docs.collect()}
    counts = Counter(w for i, t in tokens.items() if int(i) % 5 for w in t)
    total, distinct = sum(counts.values()), len(counts)
    model, table = class_model.train(rows.filter("not flag"), clustered=80, classes=8, known=known)
    got = class_model.score_texts(rows, model, table).collect()
    assert model.train == total
    for r in got:
        own = tokens[r["id"]]
        assert (r["n_tokens"], r["n_known"]) == (len(own), sum(counts[w] > 0 for w in own))
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own), abs=1e-6)
    held = [r for r in got if r["flag"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_exchange_finds_alternating_classes():
    pairs = np.zeros((8, 8), np.int64)
    for a in (0, 2, 4):
        for b in (1, 3, 5):
            pairs[a, b] = pairs[b, a] = 50
    own = class_model.exchange(pairs, 2)
    assert len({own[0], own[2], own[4]}) == 1 and len({own[1], own[3], own[5]}) == 1 and own[0] != own[1]


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.held_out()))
    rows = language_id.classify(docs.filter(language_id.held_out()), model)
    right = rows.select(F.avg((F.col("lang") == F.col("language.lang")).cast("double")), F.sum(F.col("language.rejected").cast("int"))).first()
    assert right[0] > 0.97 and right[1] <= 3


def test_language_far_from_every_centroid_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.held_out()))
    rng = random.Random(4)
    far = [" ".join("".join(rng.choice(letters) for _ in range(9)) for _ in range(400)) for letters in ("zxqjkw", "αβγδεζ", "一二三四五六")]
    assert model.predict(far)["rejected"].all() and model.predict([far[0] * 200])["rejected"].all()


def test_language_bounds_of_classes_without_texts():
    got = language_id.bounds_of({8: 0.3, 9: 0.2, 12: 0.4})
    assert got.tolist() == [0.2] * 10 + [0.4] * 11
    assert language_id.bounds_of({}).tolist() == [0.0] * 21


def test_license_phrases_and_edits(spark):
    texts = [
        "The MIT-License, the mit license; general\npublic LICENSE", "submit license mit licenses", None,
        "Permision is hereby granted, free of charge, to any person obtaning a copy", "permission was sometimes granted to copy",
    ]
    rows = {r["id"]: r for r in license_scan.license_scan(frame(spark, texts)).collect()}
    assert [(b["label"], b["word"]) for b in rows[0]["base"]] == [("mit", 1), ("mit", 4), ("gpl", 6)]
    assert not rows[1]["base"] and rows[2]["n_words"] == 0 and not rows[4]["spans"]
    span = rows[3]["spans"][0]
    assert (span["label"], span["start"], span["end"], span["errors"]) == ("mit", 0, 13, 2) and 0.9 < rows[3]["score"] < 1


def test_license_places_close_together():
    find = license_scan.Notices({"all rights reserved": "own"}, 8)
    text = "all rigts reservd xx all rights reserved yy all rights reserved all rights resrved"
    assert [(text[a:b], errors) for _, a, b, errors, _ in find.spans(text)] == [
        ("all rigts reservd", 2), ("all rights reserved", 0), ("all rights reserved", 0), ("all rights resrved", 1),
    ]


def test_license_seeds_lose_no_match():
    import regex

    rng = random.Random(4)
    text, errors = "redistribution and use in source and binary forms", 6
    find = license_scan.Notices({text: "bsd"}, 8)
    for _ in range(200):
        chars = list(text)
        for _ in range(errors):
            k = rng.randrange(len(chars))
            chars[k : k + 1] = rng.choice([[], [chars[k], "q"], ["z"]])
        whole = f"some words {''.join(chars)} and more"
        if regex.search(rf"(?<![^ ])(?:{text}){{e<=6}}(?![^ ])", whole):
            assert find.spans(whole)


def test_mixing_meets_targets(spark):
    texts = ["w " * (1 + (i * 37) % 300) for i in range(1500)]
    docs = frame(spark, texts).withColumn("source", F.when(F.col("doc_id") % 11 == 0, None).when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") < 60, "b").otherwise("c"))
    mixed = mixing.mix(docs)
    rows = mixed.groupBy("source", "source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("copies").alias("most")).collect()
    total = sum(r["source_size"] for r in rows)
    assert sum(r["target"] for r in rows) == pytest.approx(total)
    for r in rows:
        assert r["target"] <= 3 * r["source_size"] and r["most"] <= 3
        assert abs(r["taken"] - r["target"]) <= 600
    assert mixing.emit(mixed).count() == mixed.agg(F.sum("copies")).first()[0]


def test_mixing_shuffles_the_texts_once_and_needs_no_python_worker(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")  # the documents are more, the sources less
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("w"), "id").alias("text"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    mixed = mixing.mix(docs)
    plan = mixed._jdf.queryExecution().explainString(mixed._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"\) Exchange\s+Input \[\d+\]: \[([^\]]*)\]", plan)
    assert sum("text#" in columns for columns in shuffled) == 1
    assert "ExistingRDD" not in plan and "Python" not in plan
    assert {r["source"] for r in mixed.collect()} == {None, "s1", "s2", "s3"}


def test_targets_share_the_excess():
    assert mixing.targets([("a", 10), ("b", 1000), ("c", 1000)], (5, 2, 1), 3) == [30.0, 2 * 1980 / 3, 1980 / 3]
    assert mixing.targets([("a", 0), ("b", 9)], (5, 2, 1), 3) == [0.0, 9.0]
    assert mixing.targets([], (5, 2, 1), 3) == []


def test_quality_counts_and_outliers(spark):
    rng = random.Random(3)
    texts = [" ".join(f"v{rng.randrange(5000)}" for _ in range(80)) + ("\n\nline again x\nline again x" if i % 9 == 0 else "") for i in range(300)]
    texts += [" ".join(f"v{i}###" for i in range(80))] * 5
    docs = frame(spark, texts).withColumn("source", F.lit("s"))
    rows = {r["id"]: r for r in quality_rules.quality(docs).collect()}
    for i, t in enumerate(texts):
        words = WORDS.findall(t)
        times = Counter(zip(words, words[1:], words[2:]))
        cover = {k + j for k in range(len(words) - 2) if times[tuple(words[k : k + 3])] > 1 for j in range(3)}
        lines = t.split("\n")
        again = sum(bool(WORDS.search(x)) and x in lines[:k] for k, x in enumerate(lines))
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), again, len(cover),
        )
    assert sum(rows[i]["kept"] for i in range(300)) == 300 and not any(rows[i]["kept"] for i in range(300, 305))


def test_quality_rejects_each_single_statistic(spark):
    rng = random.Random(5)
    words = lambda n, size=6: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size)) for _ in range(n)]
    texts = [" ".join(words(rng.randint(100, 200))) for _ in range(200)]
    some = words(45)
    lines = [" ".join(words(15)) for _ in range(2)]
    odd = [
        " ".join(words(100, 12)),  # long words
        " ".join(words(100)) + " #" * 2 + " $%*&" * 1,  # symbols: 6 in 103 words
        " ".join(words(100)) + "\nab\nab\ncd\ncd\nef\nef\ngh\ngh\nij\nij",  # 5 lines that stand twice
        " ".join(some + words(110) + some),  # 45 % of the words stand in repeated windows
        "\n".join([*lines, *lines, " ".join(words(90))]),  # 40 % of the words in lines that stand twice
    ]
    docs = frame(spark, texts + odd).withColumn("source", F.lit("s"))
    rows = {r["id"]: r for r in quality_rules.quality(docs).collect()}
    assert not any(r["base_failed"] for r in rows.values())
    assert [rows[200 + i]["kept"] for i in range(len(odd))] == [False] * len(odd)
    assert sum(rows[i]["kept"] for i in range(200)) >= 198


def test_chi_square():
    assert quality_rules.chi2_quantile(0.95, 4) == pytest.approx(9.4877, abs=1e-3)
    assert quality_rules.chi2_cdf(5.3853, 6) == pytest.approx(0.5046, abs=1e-3)


def test_sharding(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sharding.shard(docs, bucket_bytes=20_000).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(docs.count()))
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert all(r["grown_shard"] in (r["shard"], 24) for r in rows) and any(r["grown_shard"] == 24 for r in rows)
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(docs, bucket_bytes=20_000).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    more = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, shards=25).collect()}
    assert more == {r["doc_id"]: r["grown_shard"] for r in rows}


def test_written_shards_hold_all_texts(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sharding.write_shards(sharding.shard(docs), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    digest = F.sum(F.crc32(F.col("text").cast("binary")))
    assert back.agg(digest).first() == docs.agg(digest).first() and back.select("shard").distinct().count() == 24


def test_held_out_is_crc_of_the_id(spark):
    rows = spark.range(50).select(F.col("id"), language_id.held_out("id").alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


def test_class_model_puts_every_word_into_a_class(spark):
    rng = random.Random(8)
    nouns, verbs = [f"n{i}" for i in range(60)], [f"v{i}" for i in range(60)]
    skew = lambda words: words[min(int(rng.expovariate(0.15)), 59)]
    texts = [" ".join(skew((nouns, verbs)[i % 2]) for i in range(40)) for _ in range(300)]
    rows = frame(spark, texts).select(F.col("doc_id").cast("string").alias("id"), F.lit(False).alias("flag"), F.col("text").cast("binary").alias("text"))
    counts = Counter(w for t in texts for w in t.split())
    got = []
    for known in (5, 100_000):
        model, words = class_model.train(rows, clustered=20, classes=2, known=known)
        found = {r["word"].decode(): (r["n"], r["c"]) for r in words.collect()}
        assert {w: n for w, (n, _) in found.items()} == counts
        kinds = [{c for w, (_, c) in found.items() if w[0] == k} for k in "nv"]
        assert len(kinds[0]) == len(kinds[1]) == 1 and kinds[0] != kinds[1]
        of = lambda w: found[w][1]
        paths = [[model.end, *map(of, t.split()), model.end] for t in texts]
        steps = Counter(p for path in paths for p in zip(path, path[1:]))
        for a in {a for a, _ in steps}:
            line = [steps[a, d] for d in range(4)]
            assert model.step[a] == pytest.approx([math.log10((n + 0.5) / (sum(line) + 2)) for n in line])
        got.append({r["id"]: r["score"] for r in class_model.score_texts(rows, model, words).collect()})
        for i, (t, path) in enumerate(zip(texts, paths)):
            sizes = sum(math.log10((counts[w] + 1) / model.size[of(w)]) for w in t.split()) + math.log10(301 / 301)
            assert got[-1][str(i)] == pytest.approx(sizes + sum(model.step[a, b] for a, b in zip(path, path[1:])))
    assert got[0] == pytest.approx(got[1])


def family(seed: int, n: int, words: int, changed: int) -> list[str]:
    """Copies of one text with some words changed: alike, but mostly below the threshold of each other."""
    rng = random.Random(seed)
    base, out = [f"b{i}" for i in range(words)], []
    for k in range(n):
        copy = list(base)
        for i in rng.sample(range(words), changed):
            copy[i] = f"c{k}x{i}"
        out.append(" ".join(copy))
    return out


def test_sketches_keep_every_linked_pair_and_few_others():
    rng = np.random.default_rng(3)
    words = ngram_join.Words()
    texts = [t.encode() for t in family(2, 60, 200, 9) + family(2, 20, 200, 2)]
    sets = [ngram_join.shingles(words, t, 4) for t in texts]
    batch = ngram_join.pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    rows = next(ngram_join._sketches(4)(iter([batch])))
    order = rng.permutation(len(texts))
    labels = np.zeros(len(texts), np.int64)
    labels[1:] = np.arange(1, len(texts))
    found = set()
    for a, b in ngram_join.near_pairs(85, np.arange(len(texts)), labels, np.asarray(rows.column("n")), rows.column("bins").to_pylist(), order[:50], order):
        found |= set(zip(a.tolist(), b.tolist()))
    linked = set()
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common) and {a, b} & set(order[:50].tolist()):
                linked.add((a, b))
    assert linked and linked <= found and len(found) < 200  # of about 2700 pairs


def test_near_pairs_holds_few_megabytes():
    rng = np.random.default_rng(4)
    bins = [rng.integers(0, 2, 2048, np.uint8).tobytes() for _ in range(300)]
    bins[299] = bins[0]
    sizes, ids = np.array([sum(b) for b in bins]), np.arange(300)
    tracemalloc.start()
    found = sum(len(a) for a, _ in ngram_join.near_pairs(99, ids, ids, sizes, bins, ids, ids))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 2 and most < 16 << 20  # the sketches take 2.5 MB


@pytest.mark.parametrize("block", [1024, 7])
def test_ngram_join_compares_few_pairs_of_a_group_below_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    staged, made = ngram_join.staged, {}

    def counted(df, name):
        out = staged(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(ngram_join, "staged", counted)
    texts = family(5, 60, 200, 8) + family(6, 12, 200, 2)
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    edges = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = list(range(len(texts)))
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["id"]: r["component_id"] for r in ngram_join.similarity_groups(frame(spark, texts), width=4, percent=85)[0].collect()}
    assert got == dict(enumerate(root))
    assert made["open-groups"] > 0 and made["pairs-across"] < 200  # of 1770 pairs in the large family


def test_ngram_join_reads_texts_only_of_pairs_whose_sketches_are_near(spark, monkeypatch):
    staged, made = ngram_join.staged, {}

    def counted(df, name):
        out = staged(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(ngram_join, "staged", counted)
    texts = family(5, 60, 200, 8) + family(6, 12, 200, 2)
    got = {r["id"]: r["component_id"] for r in ngram_join.similarity_groups(frame(spark, texts), width=4, percent=85)[0].collect()}
    assert all(got[i] == i for i in range(60)) and made["set-pairs"] > 60
    assert made["candidate-texts"] <= 24  # those of the second family, read for at most two comparisons


def test_small_groups_met_together_keep_every_linked_pair(monkeypatch):
    texts = [t.encode() for t in family(2, 40, 200, 2) + family(3, 30, 60, 1) + family(4, 20, 900, 9)]
    rows = next(ngram_join._sketches(4)(iter([ngram_join.pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})])))
    rng, member = np.random.default_rng(1), []
    for g in range(40):
        member += [(g, i) for i in sorted(rng.choice(len(texts), int(rng.integers(2, 30)), replace=False).tolist())]
    g, i = (np.array(v, np.int64) for v in zip(*member))
    zero = np.zeros(len(g), np.int32)
    columns = {"g": g, "x": zero, "y": zero, "own": zero, "blocks": zero + 1, "id": i, "c": i // 3, "n": np.asarray(rows.column("n"))[i]}
    columns["bins"] = [rows.column("bins")[k].as_py() for k in i.tolist()]
    table = ngram_join.pa.table(columns)

    def met(most):
        monkeypatch.setattr(ngram_join, "FEW", most)
        out = ngram_join.pa.Table.from_batches(ngram_join._near(85)(iter(table.to_batches(max_chunksize=50))))
        return set(zip(out.column("a").to_pylist(), out.column("b").to_pylist()))

    words, linked = ngram_join.Words(), set()
    sets = [ngram_join.shingles(words, t, 4) for t in texts]
    for k in range(40):
        own = i[g == k].tolist()
        for a, b in ((a, b) for a in own for b in own if a < b and a // 3 != b // 3):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                linked.add((a, b))
    together = met(64)
    assert linked and linked <= together <= met(0)  # a block takes the shortest sketch for all its pairs


def test_few_rows_take_few_tasks(spark, monkeypatch):
    staged, files = graph.staged, {}

    def counted(df, name):
        out = staged(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "staged", counted)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)], "a bigint, b bigint")
    try:
        for n, v in zip(names, ("40", "false")):
            spark.conf.set(n, v)
        got = {r["id"]: r["component"] for r in components(edges).collect()}
        joined = {r["id"]: r["component"] for r in components(edges, broadcast_ids=0).collect()}
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert got == joined == {i: 0 for i in range(101)}
    assert files == {"links": 1, "labels": 1}


def test_keys_of_five_word_shingles_are_fewer_than_the_shingles():
    rng = np.random.default_rng(2)
    sizes = np.array([60, 150, 240, 400, 900, 3000] * 3)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in sizes]
    for percent in (80, 85):
        assert len(ngram_join.Partition(percent).keys(sets, sizes)[0]) < sizes.sum()
