"""Merge of JSON records from many sources by id, with provenance-tagged field names.

Input records have ``id STRING, tag STRING, v VARIANT`` (an object) and the arrival order columns
``file, block, pos`` and, where a line holds several records, ``item``; a block is one input split, which bounds the rows
per (file, block).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.ranking import group_rank
from larder.session import ship_package, staged

ARRIVAL = ("file", "block", "pos", "item")
SPLIT = ("file", "block")


def require_id(records: DataFrame) -> DataFrame:
    """Drop records without an id."""
    return records.filter(F.col("id").isNotNull() & (F.trim("id") != ""))


def explode_fields(records: DataFrame) -> DataFrame:
    """One row per top-level field; a record without fields has one row without a name. ``first`` marks one row per record."""
    spark = records.sparkSession
    if "item" not in records.columns:
        records = records.withColumn("item", F.lit(0))
    fields = spark.tvf.variant_explode(F.col("v").outer()).select(F.col("pos").alias("nth"), F.col("key").alias("field"), F.col("value"))
    base = F.concat(F.col("field"), F.lit("__from_"), F.col("tag")).alias("base")
    first = F.coalesce(F.col("nth"), F.lit(0)) == 0
    return records.lateralJoin(fields).select("id", *ARRIVAL, first.alias("first"), "field", base, _root(F.col("field")).alias("root"), "value")


def stage_fields(records: DataFrame) -> DataFrame:
    """Fields of the records with an id, stored: sources are read and parsed once, and later steps read only the columns they need."""
    return staged(explode_fields(require_id(records)), "record-fields")


def _numbered(base: Column, n: Column) -> Column:
    return F.when(n == 1, base).otherwise(F.concat_ws("_", base, n.cast("string")))


def _root(field: Column) -> Column:
    """Part before ``__from_``: two fields can only compete for a name when they share it."""
    return F.substring_index(field, "__from_", 1)


# Names that look generated: a base name and a number from 2 on.
GENERATED = r"^(.*)_([2-9]|[1-9][0-9]{1,17})$"


def _free_numbers(rows: DataFrame) -> DataFrame:
    """``id, *ARRIVAL, field, name, n`` of rows whose base names may look like generated ones, first come first served.

    The first arrival of a base claims it as its name; the others queue for the numbers of the base from 2 on. A base called ``b_k`` and the
    queue of ``b`` compete for one name. Going up in ``k``, the base has it if fewer of the queue came before than there are free
    numbers below ``k``; then the queue leaves this number out. So the m-th of a queue finds its number by binary search among the numbers left
    out. A base that loses its name queues itself, which only longer names can notice: the rounds end when no verdict changes. Counts
    before a claim are sums per split and a count inside one split, so no queue is gathered.
    """
    spark = rows.sparkSession
    arrival = F.struct(*ARRIVAL, "field")
    rows = staged(rows.select("id", "base", "field", *ARRIVAL, arrival.alias("t")), "clashing-fields")
    firsts = rows.groupBy("id", "base").agg(F.min("t").alias("t0"))
    claims = firsts.select(
        "id", F.col("base").alias("name"), F.regexp_extract("base", GENERATED, 1).alias("base"),
        F.try_to_number(F.regexp_extract("base", GENERATED, 2), F.lit("9" * 18)).cast("bigint").alias("k"), F.col("t0").alias("tc"),
    ).filter("k IS NOT NULL")
    claims = staged(claims.join(firsts.select("id", "base"), ["id", "base"], "left_semi"), "claimed-names")
    known = rows.join(firsts, ["id", "base"])
    lost = spark.createDataFrame([], "id string, base string")
    while True:
        queue = known.join(lost.withColumn("_lost", F.lit(True)), ["id", "base"], "left").filter((F.col("t") > F.col("t0")) | F.col("_lost"))
        queue = staged(queue.select(*rows.columns), "queued-fields")
        splits = queue.groupBy("id", "base", *SPLIT).agg(F.count(F.lit(1)).alias("n"))
        earlier = claims.join(splits, ["id", "base"]).filter(F.struct(*SPLIT) < F.struct(*[F.col(f"tc.{c}") for c in SPLIT]))
        inside = claims.withColumns({c: F.col(f"tc.{c}") for c in SPLIT}).join(queue.select("id", "base", *SPLIT, "t"), ["id", "base", *SPLIT])
        ahead = earlier.select("id", "base", "name", "n").unionByName(inside.filter("t < tc").select("id", "base", "name", F.lit(1).cast("bigint").alias("n")))
        ahead = ahead.groupBy("id", "base", "name").agg(F.sum("n").alias("ahead"))
        judged = claims.join(ahead, ["id", "base", "name"], "left").groupBy("id", "base").agg(
            F.array_sort(F.collect_list(F.struct("k", F.coalesce("ahead", F.lit(0)).alias("ahead"), "name"))).alias("c")
        )
        start = F.struct(F.array().cast("array<bigint>").alias("out"), F.array().cast("array<string>").alias("lost"))
        verdict = F.aggregate("c", start, lambda x, c: F.when(
            c["k"] - 2 - F.size(x["out"]) >= c["ahead"], F.struct(F.array_append(x["out"], c["k"]).alias("out"), x["lost"].alias("lost"))
        ).otherwise(F.struct(x["out"].alias("out"), F.array_append(x["lost"], c["name"]).alias("lost"))))
        judged = staged(judged.select("id", "base", verdict.alias("v")), "claim-verdicts")
        now = judged.select("id", F.explode("v.lost").alias("base"))
        same = now.exceptAll(lost).isEmpty() and lost.exceptAll(now).isEmpty()
        lost = now
        if same:
            break
    ranked = group_rank(queue, ["id", "base"], [*ARRIVAL, "field"], "m", chunk=list(SPLIT))
    ranked = ranked.join(judged.select("id", "base", F.col("v.out").alias("out")), ["id", "base"], "left")
    numbered = ranked.withColumn("n", F.col("m") + 1 + _left_out(F.coalesce("out", F.array().cast("array<bigint>")), F.col("m")))
    won = known.join(lost, ["id", "base"], "left_anti").filter("t = t0").withColumn("n", F.lit(1).cast("bigint"))
    out = numbered.select("id", *ARRIVAL, "field", "base", "n").unionByName(won.select("id", *ARRIVAL, "field", "base", "n"))
    return out.select("id", *ARRIVAL, "field", _numbered(F.col("base"), F.col("n")).alias("name"), "n")


def _left_out(out: Column, m: Column) -> Column:
    """How many of the sorted numbers left out come before the m-th free number from 2 on: the first j with out[j] - 2 - j >= m."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(out) + 1)).cast("int"))

    def halve(x: Column, _: Column) -> Column:
        mid = F.floor((x["lo"] + x["hi"]) / 2).cast("int")
        before = F.get(out, mid) - 2 - mid < m
        move = F.when(before, F.struct((mid + 1).alias("lo"), x["hi"].alias("hi"))).otherwise(F.struct(x["lo"].alias("lo"), mid.alias("hi")))
        return F.when(x["lo"] < x["hi"], move).otherwise(x)

    whole = F.struct(F.lit(0).alias("lo"), F.size(out).alias("hi"))
    return F.aggregate(steps, whole, halve)["lo"].cast("bigint")


def _clashing_roots(fields: DataFrame, always_tag: bool) -> DataFrame:
    """(id, root) pairs where a generated name may equal the name of another field."""
    counts = fields.groupBy("id", "base").count()
    suffix = r"^(.*)_([2-9]|[1-9][0-9]+)$"
    literal = counts.select(
        "id",
        F.regexp_extract("base", suffix, 1).alias("base"),
        F.nullif(F.regexp_extract("base", suffix, 2), F.lit("")).cast("decimal(38,0)").alias("suffix"),
    ).filter(F.col("suffix").isNotNull())
    hits = counts.join(literal, ["id", "base"]).filter(F.col("count") >= F.col("suffix"))
    roots = hits.select("id", _root(F.col("base")).alias("root"))
    if not always_tag:
        kinds = fields.select("id", "field", _root(F.col("field")).alias("root")).distinct()
        tagged = F.max(F.col("field").contains("__from_"))
        grouped = kinds.groupBy("id", "root").agg(tagged.alias("tagged"), F.count(F.lit(1)).alias("n"))
        roots = roots.union(grouped.filter("tagged AND n > 1").select("id", "root"))
    return roots.distinct()


def _first_free_names(always_tag: bool):
    """Assign names in arrival order, remembering only the next free suffix of each base name.

    Rows come sorted by (id, root, arrival), so the state is small and is reset at each new pair.
    """

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, bare, following = None, set(), {}

        def taken(name: str) -> bool:
            head, _, tail = name.rpartition("_")
            in_series = tail.isdigit() and not tail.startswith("0") and following.get(head, 0) > int(tail) > 1
            return name in bare or in_series

        for batch in batches:
            names, numbers = [], []
            for id_, root, field, base in zip(batch["id"], batch["root"], batch["field"], batch["base"]):
                if (id_, root) != current:
                    current, bare, following = (id_, root), set(), {}
                choices = (base,) if always_tag else (field, base)
                name = next((c for c in choices if not taken(c)), None)
                number = 1
                if name is None:
                    number = following.get(base, 2)
                    while f"{base}_{number}" in bare:
                        number += 1
                    following[base] = number + 1
                    name = f"{base}_{number}"
                else:
                    bare.add(name)
                names.append(name)
                numbers.append(number)
            yield batch[["id", *ARRIVAL, "field"]].assign(name=names, n=numbers)

    return assign


def tagged_merge_long(
    records: DataFrame,
    skip: Sequence[str] = ("url", "partition"),
    always_tag: bool = True,
) -> DataFrame:
    """Merged fields in long form: ``id, name, n, value``.

    Each field is named ``<field>__from_<tag>``; the n-th arrival of a name within an id gets ``_n``.
    With ``always_tag=False`` the first arrival of a field keeps its bare name. Numbers are given per
    input split and shifted by the sizes of earlier splits, so an id with very many records is not
    gathered anywhere. Where a source field is literally called like a generated name, the two compete in the order of arrival
    (``_free_numbers``); bare names are then handed out one by one, in a sorted pass that keeps no rows.
    """
    return merge_fields(stage_fields(records), skip, always_tag)


def merge_fields(fields: DataFrame, skip: Sequence[str] = ("url", "partition"), always_tag: bool = True) -> DataFrame:
    """``tagged_merge_long`` of stored fields.

    Only names that arrive more than once in an id, and those that may clash, are numbered, without their values; all other fields
    take their name from a look at the counts.
    """
    fields = fields.filter(F.col("field").isNotNull() & ~F.col("field").isin("id", *skip))
    narrow = fields.drop("value", "first")
    clashing = _clashing_roots(narrow, always_tag)
    key = "base" if always_tag else "field"
    repeated = narrow.groupBy("id", key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("id", key)
    some = narrow.join(repeated, ["id", key], "left_semi")
    clashes = not clashing.isEmpty()
    if clashes:
        clashing = staged(clashing, "clashing-names")
        some = some.join(clashing, ["id", "root"], "left_anti")

    ranked = group_rank(some, ["id", key], list(ARRIVAL), "n", chunk=list(SPLIT))
    if always_tag:
        numbers = ranked.select("id", *ARRIVAL, "field", _numbered(F.col("base"), F.col("n")).alias("name"), "n")
    else:
        later = group_rank(
            ranked.filter("n > 1").drop("n"), ["id", "base"], list(ARRIVAL), "n", chunk=list(SPLIT)
        )
        numbers = later.select("id", *ARRIVAL, "field", _numbered(F.col("base"), F.col("n")).alias("name"), "n")
    if clashes and always_tag:
        numbers = numbers.unionByName(_free_numbers(narrow.join(clashing, ["id", "root"], "left_semi")))
    elif clashes:
        ship_package(fields.sparkSession)
        ordered = (
            narrow.join(clashing, ["id", "root"], "left_semi")
            .select("id", "root", "field", "base", *ARRIVAL)
            .repartition("id", "root")
            .sortWithinPartitions("id", "root", *ARRIVAL)
        )
        schema = "id string, file string, block bigint, pos bigint, item int, field string, name string, n bigint"
        numbers = numbers.unionByName(ordered.mapInPandas(_first_free_names(always_tag), schema))
    named = fields.join(numbers, ["id", *ARRIVAL, "field"], "left")
    return named.select("id", F.coalesce("name", key).alias("name"), F.coalesce("n", F.lit(1)).alias("n"), "value")


def tagged_merge(
    records: DataFrame,
    skip: Sequence[str] = ("url", "partition"),
    always_tag: bool = True,
    part_width: int = 1024,
) -> DataFrame:
    """Merged records as ``id, part, fields MAP<STRING, VARIANT>``.

    An ordinary id is one row with part 0. Fields numbered beyond ``part_width`` go to part 1, 2, ... so
    a row is bounded by ``part_width`` times the number of distinct field names.
    """
    return merged_rows(stage_fields(records), skip, always_tag, part_width)


def merged_rows(
    fields: DataFrame, skip: Sequence[str] = ("url", "partition"), always_tag: bool = True, part_width: int = 1024
) -> DataFrame:
    """``tagged_merge`` of stored fields."""
    long = merge_fields(fields, skip, always_tag)
    part = F.floor((F.col("n") - 1) / F.lit(part_width)).cast("bigint")
    entries = long.select("id", part.alias("part"), F.struct("name", "value").alias("entry"))
    bare = fields.filter("first").select("id", F.lit(0).cast("bigint").alias("part"), F.lit(None).alias("entry"))
    return (
        entries.unionByName(bare)
        .groupBy("id", "part")
        .agg(F.map_from_entries(F.collect_list("entry")).alias("fields"))
    )


def pick_fields(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """Chosen names of the long form as columns, one row per id, combined before the shuffle."""
    return long.groupBy("id").agg(
        *[F.first(F.when(F.col("name") == n, F.col("value")), ignorenulls=True).alias(n) for n in names]
    )


def merge_counters(records: DataFrame) -> DataFrame:
    """Records per file, plus the total and the number of distinct ids on every row."""
    return _counters(require_id(records))


def field_counters(fields: DataFrame) -> DataFrame:
    """``merge_counters`` of stored fields."""
    return _counters(fields.filter("first"))


def _counters(valid: DataFrame) -> DataFrame:
    per_file = valid.groupBy("file").agg(F.count(F.lit(1)).alias("records"))
    totals = valid.agg(
        F.count(F.lit(1)).alias("total_records"), F.countDistinct("id").alias("unique_ids")
    )
    t = totals.select(F.struct("*")).scalar()
    return per_file.select(
        "file", "records", t["total_records"].alias("total_records"), t["unique_ids"].alias("unique_ids")
    )
