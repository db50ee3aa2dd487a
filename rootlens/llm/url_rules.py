"""URL filter by a sort-merge range join of urls with host and path rules.

A rule (host, path) becomes the key ``reversed.host.labels/path``; every url it
fits has a key that starts with it, so the rule is an interval of sorted keys.
A url gets one key for each suffix of its host that is as long as some rule's
host. Keys and rules are dealt into the same key ranges, sorted, and swept once;
the rules open at a key are nested and stand on a stack, the longest on top.

Bounds: a range holds about the same number of keys, equal keys are told apart
by a hash and so can fill many ranges; a rule is copied only to the ranges that
its interval meets; a sweep holds one stack. The range limits come from a sample
of fixed size per range, which steers the layout and never the result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootlens.llm.frames import Scratch, lower_ascii, only, tasks

#: Sampled keys for each key range.
SAMPLED_PER_RANGE = 30
#: Sorts after every character a key can hold.
LAST = "\U0010ffff"

RULES = "host string, path string, verdict string"
_SWEPT = "page_id long, host string, path string, copies long, rule_host string, rule_path string, rule_verdict string"


def split_url(urls: DataFrame) -> DataFrame:
    """page_id, host, path of page_id, url; a url that is null or has no ``://`` has both empty."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return urls.select(
        "page_id",
        F.coalesce(lower_ascii(host), F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
    )


def _key(labels, path):
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path)


def _ranged(keys: DataFrame, n: int) -> list[tuple[str, str]]:
    """n - 1 sorted limits out of a sample of at most SAMPLED_PER_RANGE * n keys."""
    sample = keys.select("base", "tie").orderBy(F.xxhash64("base", "tie"), "base", "tie").limit(SAMPLED_PER_RANGE * n)
    found = sorted((r[0], r[1]) for r in sample.collect())
    return [found[i * len(found) // n] for i in range(1, n)] if found else []


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The longest rule for each key; rows come sorted by (part, key), rules before urls of a key."""
    stack: list[tuple[str, str, str, str]] = []
    part = None
    for batch in batches:
        at, out = [], ([], [], [])
        for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in ("part", "base", "is_url", "host", "path", "verdict")), strict=True)):
            if row[0] != part:
                part, stack = row[0], []
            while stack and not row[1].startswith(stack[-1][0]):
                stack.pop()
            if not row[2]:
                stack.append((row[1], *row[3:]))
            elif stack:
                at.append(i)
                for column, value in zip(out, stack[-1][1:], strict=True):
                    column.append(value)
        if at:
            kept = batch.select(["page_id", "host", "path", "copies"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array(x, pa.string()) for x in out)],
                names=["page_id", "host", "path", "copies", "rule_host", "rule_path", "rule_verdict"],
            )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    ``rules`` has host, path, verdict. A rule fits its host and all subdomains
    if the url's path starts with the rule's path; the one with the longest
    path and host wins. Without one, rule is null and verdict is ``default``.

    Defined cases: a null or odd url has empty host and path and so no rule; a
    rule with a null part is left out; of two rules with equal host and path,
    the verdict that sorts last (``block`` after ``allow``) holds; fitting rules
    of equal length: the longer host wins; repeated
    rows are judged each; a null id stays null; an empty table gives no rows;
    other columns of either table are ignored.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    rules = (
        rules.select("host", "path", "verdict")
        .dropna()
        .groupBy(lower_ascii(F.col("host")).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    rules = scratch.store(rules, "rules")
    # equal rows travel as one
    urls = split_url(only(pages, page_id=id_column, url=url_column))
    urls = scratch.store(urls.groupBy("page_id", "host", "path").agg(F.count("*").alias("copies")), "urls")

    labels = F.split("host", r"\.")
    deepest = rules.agg(F.max(F.size(labels))).first()[0] or 0
    suffixes = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest)))
    keyed = (
        urls.filter((F.col("host") != "") & F.lit(deepest > 0))
        .withColumn("take", F.explode(suffixes))
        .withColumn("base", _key(F.slice(labels, -F.col("take"), F.col("take")), F.col("path")))
        # lets rows with one key fill several ranges
        .withColumn("tie", F.hex(F.xxhash64("page_id", "host", "path")))
        .select("base", "tie", "page_id", "host", "path", "copies")
    )
    n = tasks(spark)
    limits = _ranged(keyed, n)

    @F.pandas_udf(T.IntegerType())
    def part_of(base: pd.Series, tie: pd.Series) -> pd.Series:
        parts = [bisect.bisect_right(limits, key) for key in zip(base, tie, strict=True)]
        return pd.Series(parts, dtype="int32")

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def parts_of(base: pd.Series) -> pd.Series:
        ends = ((bisect.bisect_right(limits, (k, "")), bisect.bisect_right(limits, (k + LAST, ""))) for k in base)
        return pd.Series([list(range(first, last + 1)) for first, last in ends], dtype="object")

    none = F.lit(None)
    opened = rules.withColumn("base", _key(labels, F.col("path"))).select(
        F.explode(parts_of("base")).alias("part"),
        "base",
        F.lit("").alias("tie"),
        F.lit(False).alias("is_url"),
        none.cast("long").alias("page_id"),
        "host",
        "path",
        none.cast("long").alias("copies"),
        "verdict",
    )
    events = keyed.withColumns({"part": part_of("base", "tie"), "is_url": F.lit(True), "verdict": none.cast("string")})
    swept = (
        opened.unionByName(events)
        .repartition(n, "part")
        .sortWithinPartitions("part", "base", "is_url", "tie")
        .mapInArrow(_sweep, _SWEPT)
    )
    size = F.char_length("rule_host") + F.char_length("rule_path")
    best = F.max(F.struct(size, F.char_length("rule_host"), "rule_host", "rule_path", "rule_verdict"))
    none_found = urls.select("*", *[none.cast("string").alias(f"rule_{x}") for x in ("host", "path", "verdict")])
    return (
        swept.unionByName(none_found)
        .groupBy("page_id", "host", "path")
        .agg(best.alias("best"), F.max("copies").alias("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "page_id",
            "host",
            "path",
            F.concat("best.rule_host", "best.rule_path").alias("rule"),
            F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
        )
    )
