"""URL filters by a sort-merge range join.

A rule (host, path) covers its host and all subdomains where the URL's path starts with the rule's.
The canonical key of a host and path is the host's labels reversed, a separator, then the path:
a rule covers exactly the keys that start with its own, an interval in sort order. A URL stands
under one key for each of its host's suffixes. Rules and keys are sorted together in ranges; a
sweep over each range keeps the stack of rules whose intervals are open, so nested rules need no search.
Rules that are open where a range begins are the rules on the prefixes of its first key; they are found
by one small equi-join and enter the stack first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vejrkraft.operators.ordering import with_ranges

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "\u0001"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.when(F.instr(url, "://") > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range and key; the stack holds the rules whose prefix covers the current key."""
    at, stack = None, []
    for batch in batches:
        found = {"host": [], "path": [], "rule": [], "rule_host": [], "verdict": []}
        columns = [batch.column(c).to_pylist() for c in ("_bucket", "key", "is_rule", "host", "path", "verdict")]
        for bucket, key, is_rule, host, path, verdict in zip(*columns):
            if bucket != at:
                at, stack = bucket, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if is_rule:
                if not stack or stack[-1][0] != key:
                    stack.append((key, host + path, len(host), verdict))
            elif stack:
                for name, value in zip(found, (host, path, *stack[-1][1:])):
                    found[name].append(value)
        yield pa.RecordBatch.from_pydict(found, schema=_FOUND)


_FOUND = pa.schema(
    [
        ("host", pa.string()),
        ("path", pa.string()),
        ("rule", pa.string()),
        ("rule_host", pa.int32()),
        ("verdict", pa.string()),
    ]
)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame | Sequence[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Per row of ``pages``: id, url, host, path, the rule that decides and its verdict.

    ``rules`` has host, path and verdict, as a table of any size or a list. The longest rule (host and
    path together) that covers a URL wins, the one with the longer host if two are as long; ``rule`` is
    its host and path, null if none covers it, and then the verdict is ``default``. Of rules with the
    same host and path, ``block`` wins over other verdicts. Rules with a null host, path or verdict
    cover nothing, and an empty host neither. Null or malformed URLs have empty host and path. Repeated rows
    are judged each; other columns are not read. Only distinct (host, path) pairs are swept.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    rules = (
        rules.where("host is not null and path is not null and verdict is not null and host <> ''")
        .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max_by("verdict", F.struct((F.col("verdict") == "block"), "verdict")).alias("verdict"))
        .withColumn("key", F.concat(F.array_join(_reversed_labels(F.col("host")), "."), F.lit(_END), "path"))
    )
    # Numbers that bound the work per URL: how deep and how long rules are.
    depth, longest = rules.agg(
        F.max(F.size(F.split("host", r"\."))), F.max(F.length("key"))
    ).first()
    judged = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    judged = judged.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    if depth is None:
        return judged.withColumns(
            {"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}
        )

    labels = _reversed_labels(F.col("host"))
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth))),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(_END), F.col("path")),
    )
    urls = judged.where("host <> ''").select("host", "path").distinct()
    keys = urls.select(F.explode(suffixes).alias("key"), F.lit(0).alias("is_rule"), "host", "path")
    events = keys.withColumn("verdict", F.lit(None).cast("string")).unionByName(
        rules.withColumn("is_rule", F.lit(1))
    )
    # Rules before the keys they equal; the other columns cut a key that many URLs share.
    order = ["key", F.col("is_rule") * -1, "host", "path"]
    ranged = with_ranges(events, order)

    first = ranged.groupBy("_bucket").agg(F.min_by("key", "_row").alias("first"))
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(F.length("first"), F.lit(longest))),
        lambda n: F.substring(F.col("first"), F.lit(1), n),
    )
    carried = first.select("_bucket", F.explode(prefixes).alias("key")).join(rules, "key")
    carried = carried.select(
        "_bucket", F.length("key").cast("long").alias("_row"), "key", F.lit(1).alias("is_rule"), "host", "path", "verdict"
    ).withColumn("_row", F.col("_row") - (1 << 40))
    swept = (
        ranged.select(carried.columns)
        .unionByName(carried)
        .repartition("_bucket")
        .sortWithinPartitions("_bucket", "_row")
        .select("_bucket", "key", "is_rule", "host", "path", "verdict")
        .mapInArrow(_sweep, "host string, path string, rule string, rule_host int, verdict string")
    )
    # A host suffix gave each row; the longest rule decides.
    won = swept.groupBy("host", "path").agg(
        F.max_by(
            F.struct("rule", "verdict"),
            F.struct(F.length("rule"), "rule_host"),
        ).alias("won")
    )
    return judged.join(won, ["host", "path"], "left").select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"),
    )
