"""URL filters: exact look-up in sorted digest arrays, and host/path rules on top.

The list of blocked URLs is kept as sorted arrays of 64-bit xxhash digests,
one array per shard of the digest space. A task writes its shard's array to a
scratch file, memory-maps it, probes it with a vectorised binary search and
confirms every hit against the stored full string, so equal digests of
different URLs cannot block a page. Only distinct URLs are probed, so a URL
that a third of the pages share is probed once.

Rules ("host/path", longest first) override the list.

Defined results: a null URL, or one without ``://``, has empty host and path
and is allowed; equal rows get equal verdicts; null or empty list entries are
ignored; an empty list or table is allowed; only the key and url columns are
read.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_SHARD = 1 << 13


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, below a path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null if none fits."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):      # the longest is tested first
        ok = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        fits = F.when(ok, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(fits)
    return fits


class DigestArray:
    """A sorted array of digests in a memory-mapped file, with the strings behind them."""

    def __init__(self, digests: np.ndarray, strings: pa.Array, folder: str):
        order = np.argsort(digests, kind="stable")
        self.path = os.path.join(folder, "digests.u64")
        np.asarray(digests[order], dtype="<u8").tofile(self.path)
        self.digests = np.memmap(self.path, dtype="<u8", mode="r") if len(order) else digests
        self.strings = strings.take(pa.array(order))

    def holds(self, digests: np.ndarray, strings: pa.Array) -> np.ndarray:
        """Which probes are in the array: by binary search, then by comparing the strings."""
        lo = np.searchsorted(self.digests, digests, "left")
        hi = np.searchsorted(self.digests, digests, "right")
        found = np.zeros(len(digests), dtype=bool)
        for i in np.flatnonzero(hi > lo):
            found[i] = any(self.strings[j] == strings[i] for j in range(lo[i], hi[i]))
        return found


def _probe(listed: pa.Table, probes: pa.Table) -> pa.Table:
    with tempfile.TemporaryDirectory() as folder:
        keys = listed.column("_key").combine_chunks()
        array = DigestArray(listed.column("_digest").to_numpy().view(np.uint64), keys, folder)
        wanted = probes.column("_key").combine_chunks()
        hit = array.holds(probes.column("_digest").to_numpy().view(np.uint64), wanted)
        del array
    return pa.table({"_key": wanted.filter(pa.array(hit))})


def listed_keys(keys: DataFrame, listed: DataFrame, key: str, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """The distinct strings of ``keys`` that are in ``listed`` (both: one string column named ``key``)."""
    def distinct(frame: DataFrame) -> DataFrame:
        text = frame.select(F.col(key).cast("string").alias("_key")).filter(F.length("_key") > 0).distinct()
        return text.withColumn("_digest", F.xxhash64("_key"))

    probes, stored = distinct(keys), distinct(listed)
    shards = max(1, ceil(max(keys.count(), listed.count()) / keys_per_shard))
    # An array holds consecutive digests: the shard is the upper part of the digest space.
    shard = F.floor((F.shiftrightunsigned("_digest", 11).cast("double") / float(1 << 53)) * shards).cast("int")
    left = stored.withColumn("_shard", shard).groupBy("_shard")
    right = probes.withColumn("_shard", shard).groupBy("_shard")
    return left.cogroup(right).applyInArrow(_probe, "_key string").withColumnRenamed("_key", key)


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict, listed for every row; ``listed`` holds blocked ``host || path`` strings.

    The verdict is the longest fitting rule's, else ``block`` for a listed URL and ``allow`` for any other.
    """
    u = F.col(url).cast("string")
    rows = pages.select(F.col(key).alias("_id"), url_host(u).alias("host"), url_path(u).alias("path"))
    rows = rows.withColumn("_key", F.concat("host", "path"))
    blocked = listed_keys(rows.select("_key"), listed.toDF("_key"), "_key").withColumn("_listed", F.lit(True))
    ruled = rows.join(blocked, "_key", "left").withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select(F.col("_id").alias(key), "host", "path", F.col("_rule.rule").alias("rule"),
                        F.coalesce(F.col("_rule.verdict"), method).alias("verdict"),
                        F.coalesce("_listed", F.lit(False)).alias("listed"))
