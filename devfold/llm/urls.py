"""URL rules as a sort-merge range join over reversed hosts.

A host is keyed by its labels from the right (``www.example.net`` -> ``net.example.www.``),
so a rule's host and all its subdomains are one interval of keys. Urls and rules are dealt
over the same key ranges (a rule goes to every range its interval touches), sorted, and
swept once: a stack holds the rules whose intervals are open, innermost last.
Range bounds come from a bounded sample and only steer balance. Equal keys may be cut
between ranges by a hash, so a host with a third of all urls is shared out.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys sampled to place range bounds, ranges at most, and urls in a range below that.
SAMPLE, MOST_RANGES, RANGE_ROWS = 20_000, 1000, 200_000
_LAST = chr(0x10FFFF)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the right, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]", -1)), "."), F.lit("."))


class Open:
    """Rules of one host whose interval the sweep is inside."""

    def __init__(self, key: str) -> None:
        self.key = key
        self.paths: dict[str, tuple[str, str]] = {}
        self.sizes: list[int] = []

    def add(self, path: str, rule: str, verdict: str) -> None:
        if path not in self.paths or verdict == "block":
            self.paths[path] = (rule, verdict)
            self.sizes = sorted({len(p) for p in self.paths}, reverse=True)

    def longest(self, path: str) -> tuple[str, str] | None:
        for size in self.sizes:
            if size <= len(path) and (found := self.paths.get(path[:size])):
                return found
        return None


def sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """One pass over rows sorted by range, key and kind (rules first)."""
    stack: list[Open] = []
    part = None
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("page_id", "host", "path", "rule", "verdict")}
        for row in batch.to_pylist():
            if row["part"] != part:
                part, stack = row["part"], []
            while stack and not row["key"].startswith(stack[-1].key):
                stack.pop()
            if row["kind"] == 0:
                if not stack or stack[-1].key != row["key"]:
                    stack.append(Open(row["key"]))
                stack[-1].add(row["path"], row["host"] + row["path"], row["verdict"])
                continue
            best = None
            for level in stack:  # the longest rule wins, of equal ones the deeper host
                found = level.longest(row["path"])
                if found and (best is None or len(found[0]) >= len(best[0])):
                    best = found
            for name, value in zip(out, (row["page_id"], row["host"], row["path"], best and best[0], best[1] if best else default), strict=True):
                out[name].append(value)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Host, path, longest fitting rule and verdict of every url.

    ``rules`` has host, path and verdict; a rule with a null host fits nothing, a null path
    means any path, and of rules alike in host and path a blocking one counts. Rows of
    ``pages`` are judged one by one, so repeated or null ids stay. Without a fitting rule the
    verdict is ``default``. Only ``page_id`` and ``url`` are read; empty tables give no row.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("key", host_key(F.col("host"))).withColumn("tie", F.xxhash64("page_id", "host", "path"))
    spark = pages.sparkSession
    total = pages.count()
    ranges = min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_ROWS))
    step = max(1, total // SAMPLE)
    seen = urls.where(F.pmod("tie", F.lit(step)) == 0).select("key", "tie").orderBy("tie").limit(2 * SAMPLE).collect()
    keys = sorted((r["key"], r["tie"]) for r in seen)
    bounds = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [bisect_right(bounds, x) for x in zip(batch.column("key").to_pylist(), batch.column("tie").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *(batch.column(c) for c in columns)], names=["part", *columns])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [(bisect_left(bounds, (k,)), bisect_right(bounds, (k + _LAST,))) for k in batch.column("key").to_pylist()]
            which = [i for i, (a, b) in enumerate(spans) for _ in range(a, b + 1)]
            parts = [p for a, b in spans for p in range(a, b + 1)]
            own = batch.take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *(own.column(c) for c in columns)], names=["part", *columns])

    columns = ["key", "kind", "tie", "page_id", "host", "path", "verdict"]
    schema = "part int, key string, kind int, tie long, page_id long, host string, path string, verdict string"
    left = urls.withColumn("kind", F.lit(1)).withColumn("verdict", F.lit(None).cast("string")).select(*columns).mapInArrow(place, schema)
    known = rules.where("host IS NOT NULL").select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict").cast("string").alias("verdict"))
    known = known.withColumn("key", host_key(F.col("host"))).withColumn("kind", F.lit(0)).withColumn("tie", F.lit(0).cast("long")).withColumn("page_id", F.lit(None).cast("long"))
    right = known.select(*columns).mapInArrow(spread, schema)
    merged = left.unionByName(right).repartition(ranges, "part").sortWithinPartitions("part", "key", "kind")
    return merged.mapInArrow(lambda batches: sweep(batches, default), "page_id long, host string, path string, rule string, verdict string")
