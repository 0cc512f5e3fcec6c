"""Shared helpers of the query catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.functions import text as T
from larder.session import spread


TEXT_TABLES = ("documents", "pages", "conversations")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def quoted(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def sql_ascii(expr: str) -> str:
    singles, longer = T.replacements()
    out = f"translate({expr}, {quoted(''.join(singles))}, {quoted(''.join(singles.values()))})"
    for char, repl in longer.items():
        out = f"replace({out}, {quoted(char)}, {quoted(repl)})"
    return out


def sql_collapse(expr: str) -> str:
    return rf"trim(regexp_replace({expr}, '\s+', ' ', 'g'))"


def sql_clean(expr: str, punctuation: bool = True) -> str:
    folded = sql_ascii(f"lower(coalesce({expr}, ''))")
    if punctuation:
        folded = rf"regexp_replace({folded}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    return sql_collapse(folded)


def sql_without_stopwords(expr: str) -> str:
    words = ", ".join(quoted(w) for w in T.ENGLISH_STOPWORDS)
    kept = f"list_filter(string_split({expr}, ' '), lambda w: w <> '' AND w NOT IN ({words}))"
    return f"array_to_string({kept}, ' ')"


def sql_tokens(expr: str) -> str:
    """Number of whitespace tokens."""
    return f"len(list_filter(string_split({sql_collapse(expr)}, ' '), lambda w: w <> ''))"


def sql_file_name(expr: str) -> str:
    p = f"regexp_replace({expr}, '/{{2,}}', '/', 'g')"
    p = rf"regexp_replace({p}, '(^|/)(?:\./|\.$)+', '\1', 'g')"
    p = rf"regexp_replace({p}, '(.)/$', '\1')"
    name = f"string_split({p}, '/')[-1]"
    return f"(CASE WHEN {name} = '.' THEN '' ELSE {name} END)"


def sql_posix(expr: str) -> str:
    p = f"regexp_replace({expr}, '/{{2,}}', '/', 'g')"
    p = rf"regexp_replace({p}, '(^|/)(?:\./|\.$)+', '\1', 'g')"
    p = rf"regexp_replace({p}, '(.)/$', '\1')"
    return f"(CASE WHEN {p} = '' THEN '.' ELSE {p} END)"


def sql_stem(expr: str) -> str:
    return rf"regexp_replace({sql_file_name(expr)}, '^(.+)\.[^.]+$', '\1')"


def sql_suffix(expr: str) -> str:
    return rf"lower(regexp_extract({sql_file_name(expr)}, '^.+\.([^.]+)$', 1))"


def sql_sanitize(expr: str) -> str:
    return rf"regexp_replace({expr}, '[^\p{{L}}\p{{N}}_\-.]+', '_', 'g')"
