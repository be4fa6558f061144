"""URL filters as a sort-merge range join of urls with nested prefix rules.

A rule is (host, path, verdict). It fits a url on its host or a subdomain of it whose path starts with the
rule's path. Hosts are reversed (`com.example.www`), which turns a host and all its subdomains into one interval of a
sorted order. The hosts of all rules and urls are sorted in that one order and swept once: a stack holds the
rule hosts whose interval is open, each nested in the one below it, with their rules in the order of their paths
and the rule that encloses each. A url asks every open host for its longest rule that fits.

The order is cut into ranges, by host and path, so that a host with very many urls is spread over several tasks. A
range starts with the rules that are open at its first host: those of that host and its parents, looked up once for
each range. A task holds the rules of the hosts that are open at a time, and no urls.

Null or repeated urls, null hosts and extra columns: a null url or one without `://` has an empty host and
path and no rule. Rules with a null field are ignored. Of rules with the same host and path, block wins.
A url without rule gets `default`.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.work_tables import WorkTables

ALLOW, BLOCK = "allow", "block"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Behind every label of a key; sorts below every character of a host.
SEPARATOR = "\x01"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#`; path: from there up to `?`, `#`. Never null."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url_text, instr(url_text, '://') + 3)"))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)
    return F.coalesce(F.translate(raw, UPPER, UPPER.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """The labels from the last to the first, so that a host's key begins those of its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), SEPARATOR), F.lit(SEPARATOR))


def _parent_keys(key: Column) -> Column:
    """The key and those of all its parent domains."""
    labels = F.split(key, SEPARATOR)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), SEPARATOR), F.lit(SEPARATOR)),
    )


class _Host:
    """Rules of an open host, in the order of their paths; enclosing: the longest other rule that begins one."""

    def __init__(self, key: str) -> None:
        self.key = key
        self.paths: list[str] = []
        self.rules: list[tuple[str, str]] = []
        self.enclosing: list[int] = []

    def _around(self, at: int, path: str) -> int:
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.enclosing[at]
        return at

    def add(self, path: str, rule: str, verdict: str) -> None:
        if self.paths and self.paths[-1] == path:
            return  # open at the start of the range and in it
        self.enclosing.append(self._around(len(self.paths) - 1, path))
        self.paths.append(path)
        self.rules.append((rule, verdict))

    def find(self, path: str) -> tuple[str, str] | None:
        at = self._around(bisect_right(self.paths, path) - 1, path)
        return self.rules[at] if at >= 0 else None


class OpenRules:
    """The stack of hosts whose interval holds the key that the sweep has come to."""

    def __init__(self) -> None:
        self.stack: list[_Host] = []

    def come_to(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def add(self, key: str, path: str, rule: str, verdict: str) -> None:
        self.come_to(key)
        if not self.stack or self.stack[-1].key != key:
            self.stack.append(_Host(key))
        self.stack[-1].add(path, rule, verdict)

    def find(self, key: str, path: str) -> tuple[str, str] | None:
        """The longest rule that fits; of equally long ones that of the longer host, which lies higher."""
        self.come_to(key)
        found = [rule for host in reversed(self.stack) if (rule := host.find(path))]
        return max(found, key=lambda rule: len(rule[0]), default=None)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and key, rules before urls: for each url its rule, if any."""
    place, rules = None, OpenRules()
    for batch in batches:
        names = ("range", "key", "is_url", "path", "rule", "verdict", "host")
        out: dict[str, list] = {n: [] for n in ("host", "path", "rule", "rule_verdict")}
        columns = (batch.column(n).to_pylist() for n in names)
        for at, key, is_url, path, rule, verdict, host in zip(*columns, strict=True):
            if at != place:
                place, rules = at, OpenRules()
            if not is_url:
                rules.add(key, path, rule, verdict)
            elif found := rules.find(key, path):
                for name, value in zip(out, (host, path, *found), strict=True):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(n, pa.string()) for n in out]))


def judge_urls(
    urls: DataFrame,
    rules: DataFrame,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
    ranges: int | None = None,
) -> DataFrame:
    """Per row of `urls`: id, host, path, the longest rule that fits (host and path as one text) or null,
    and the verdict: the rule's, else `default`. Longest is by the text; equal lengths: the longer host.
    ``ranges`` is the number of ranges, by default that of shuffle partitions."""
    work = WorkTables(urls.sparkSession, "url-filter")
    url_text = urls.select(F.col(id_column), F.col(url_column).cast("string").alias("url_text"))
    host, path = host_and_path(F.col("url_text"))
    judged = url_text.select(id_column, host.alias("host"), path.alias("path"))
    no_text = F.lit(None).cast("string")
    held = (
        rules.select("host", "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max(F.col("verdict") == BLOCK).alias("blocks"))
        .select(
            host_key(F.col("host")).alias("key"),
            F.lit(False).alias("is_url"),
            "path",
            F.concat("host", "path").alias("rule"),
            F.when(F.col("blocks"), BLOCK).otherwise(ALLOW).alias("verdict"),
            no_text.alias("host"),
        )
    )
    asked = judged.where(F.col("host") != "").select("host", "path").distinct()
    asked = asked.select(
        host_key(F.col("host")).alias("key"),
        F.lit(True).alias("is_url"),
        "path",
        no_text.alias("rule"),
        no_text.alias("verdict"),
        "host",
    )
    in_order = asked.unionByName(held)
    in_order = in_order.repartitionByRange(ranges, "key", "path") if ranges else in_order.repartitionByRange("key", "path")
    # Written, so that the ranges stay what they are if a task runs again
    placed = work.keep(in_order.withColumn("range", F.spark_partition_id()), "placed")
    starts = placed.groupBy("range").agg(F.min("key").alias("start"))
    parents = starts.select("range", F.explode(_parent_keys(F.col("start"))).alias("key"))
    carried = held.join(parents, "key").select(*placed.columns)
    found = (
        placed.unionByName(carried)
        .repartition("range")
        .sortWithinPartitions("range", "key", "is_url", "path")
        .mapInArrow(_sweep, "host string, path string, rule string, rule_verdict string")
        .select("host", "path", F.struct("rule", "rule_verdict").alias("best"))
    )
    return judged.join(found, ["host", "path"], "left").select(
        id_column,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
