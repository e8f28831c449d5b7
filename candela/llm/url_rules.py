"""URL rules by a sort-merge range join over reversed-host keys.

Hosts become keys with their labels reversed ("a.example.org" -> "org.example.a."), so a rule's host and all its
subdomains form an interval of the sorted keys. Urls and rules are dealt to key ranges, sorted together, and one
sweep per range keeps a stack of the rules whose intervals are open; a url's path is looked up in the path tables
of the stacked hosts. The longest rule (host and path) wins, of equally long ones that of the longer host, and
block before allow.

Ranges come from a bounded sample of keys (``SAMPLE`` per range at most), which decides balance only. A key that
fills several ranges is spread over all of them; a rule goes to every range its interval meets.

Defined cases. Null url or one without "://": host and path empty, no rule, the default verdict. Null ids and
repeated rows stay rows. A rule with a null or empty host fits nothing; a null path is "". No
rules: every url gets the default. Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import pick

SAMPLE = 32
MAX_RANGES = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS = "part int, key string, kind int, id long, host string, path string, verdict string"


def host_and_path(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` and ``path`` (never null)."""
    at = F.instr(F.col(url_col), "://")
    after = F.when(at > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    urls = urls.withColumn("_after", F.coalesce(after, F.lit("")))
    urls = urls.withColumn("_host", F.regexp_extract("_after", "^[^/?#]*", 0))
    rest = F.expr("substring(_after, length(_host) + 1)")
    return (urls.withColumn("path", F.regexp_extract(rest, "^[^?#]*", 0)).withColumn("host", F.translate("_host", UPPER, LOWER))
            .drop("_after", "_host"))


def _key(host):
    return F.when(host == "", "").otherwise(F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit(".")))


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``rules``: host, path, verdict. Per url row: id, host, path, rule (its host and path, or null), verdict."""
    spark = urls.sparkSession
    urls = host_and_path(pick(urls, **{id_col: "long", url_col: "string"}), url_col)
    urls = urls.select(_key(F.col("host")).alias("key"), F.col(id_col).alias("id"), "host", "path")
    rules = pick(rules, host="string", path="string", verdict="string").where("host <> ''").withColumn("path", F.coalesce("path", F.lit("")))
    rules = rules.withColumn("host", F.translate("host", UPPER, LOWER)).distinct()
    ranges = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sample = urls.select("key", F.xxhash64("id", "host", "path").alias("h")).orderBy("h").limit(SAMPLE * ranges).select("key")
    keys = sorted(r.key for r in sample.toLocalIterator())
    splits = keys[SAMPLE::SAMPLE]

    def place_urls(batches):
        for batch in batches:
            parts = []
            for key, i, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                a, b = bisect_left(splits, key), bisect_right(splits, key)
                parts.append(a + crc32(f"{i} {path}".encode()) % (b - a + 1) if b > a else a)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), batch.column(0), pa.array([1] * n, pa.int32()), batch.column(1), batch.column(2), batch.column(3),
                                              pa.nulls(n, pa.string())], names=["part", "key", "kind", "id", "host", "path", "verdict"])

    def place_rules(batches):
        for batch in batches:
            out = []
            for key, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                for part in range(bisect_left(splits, key), bisect_right(splits, key + "\U0010ffff") + 1):
                    out.append((part, key, 0, None, host, path, verdict))
            types = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(types)], names=["part", "key", "kind", "id", "host", "path", "verdict"])

    def sweep(batches):
        part, stack = None, []  # of (key, host, {path: verdict}, lengths)
        for batch in batches:
            out = []
            for p, key, kind, i, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, set()))
                    table, lengths = stack[-1][2], stack[-1][3]
                    table[path] = "block" if "block" in (verdict, table.get(path)) else verdict
                    lengths.add(len(path))
                    continue
                best = None
                for _, rule_host, table, lengths in stack:
                    fits = max((n for n in lengths if n <= len(path) and path[:n] in table), default=None)
                    if fits is not None and (best is None or (len(rule_host) + fits, len(rule_host)) > best[0]):
                        best = (len(rule_host) + fits, len(rule_host)), rule_host + path[:fits], table[path[:fits]]
                out.append((i, host, path, best and best[1], best[2] if best else default))
            types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(types)], names=[id_col, "host", "path", "rule", "verdict"])

    placed = urls.mapInArrow(place_urls, ROWS).unionByName(rules.select(_key(F.col("host")).alias("key"), "host", "path", "verdict").mapInArrow(place_rules, ROWS))
    placed = placed.repartition("part").sortWithinPartitions("part", "key", "kind")
    return placed.mapInArrow(sweep, f"{id_col} long, host string, path string, rule string, verdict string")
