"""URL rules from a sorted digest array.

Rules are strings of host and path (``example.com/en/``). Their 64-bit xxhash keys are sorted into
one array, with the rules' strings and verdicts beside it, in two files that Spark ships to each
executor once. Python workers memory-map the array, so the workers of an executor share its pages.
A URL is probed with a vectorised binary search for each of its host suffixes, then for the suffix
with those path prefixes whose lengths occur under that host. Every hit is confirmed on the stored
string, so equal digests of different strings do no harm.

The files are made on the driver, so their size is checked first: ``MAX_INDEX_BYTES``. A larger list
goes through an equi-join on the probed strings instead, with the same result.
"""

from __future__ import annotations

import json
import os
import tempfile
from collections import defaultdict
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.columns import fresh

MAX_INDEX_BYTES = 256 * 2**20
VERDICT_TYPE = "struct<rule string, verdict string>"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


class DigestArray:
    """A memory-mapped sorted array of digests, and the strings behind them."""

    def __init__(self, array_file: str, strings_file: str):
        self.digests = np.load(array_file, mmap_mode="r")
        with open(strings_file, encoding="utf-8") as lines:
            held = json.load(lines)
        self.strings, self.values = held["strings"], held["values"]

    @staticmethod
    def write(entries: dict[str, object], array_file: str, strings_file: str, digest=xxhash.xxh64_intdigest) -> None:
        ordered = sorted((digest(text.encode()), text) for text in entries)
        np.save(array_file, np.array([d for d, _ in ordered], dtype=np.uint64))
        with open(strings_file, "w", encoding="utf-8") as out:
            json.dump({"strings": [t for _, t in ordered], "values": [entries[t] for _, t in ordered]}, out)

    def find(self, texts: list[str], digest=xxhash.xxh64_intdigest) -> list[object]:
        """The value stored for each text, or None."""
        keys = np.fromiter((digest(t.encode()) for t in texts), dtype=np.uint64, count=len(texts))
        first = np.searchsorted(self.digests, keys, "left")
        last = np.searchsorted(self.digests, keys, "right")
        found: list[object] = [None] * len(texts)
        for i in np.flatnonzero(last > first):
            for at in range(first[i], last[i]):
                if self.strings[at] == texts[i]:
                    found[i] = self.values[at]
        return found


def index_entries(rules: list[tuple[str, str]]) -> dict[str, object]:
    """What the array holds: a host's path lengths under ``host``, a rule's verdict under ``host/path``.

    Hosts hold no slash and paths begin with one, so the two kinds of keys differ.
    """
    entries: dict[str, object] = {}
    lengths: dict[str, set[int]] = defaultdict(set)
    for rule, verdict in rules:
        host, path = split_rule(rule)
        if not path:
            raise ValueError(f"a rule needs a path, at least a slash: {rule!r}")
        lengths[host].add(len(path))
        entries[host + path] = verdict
    for host, all_lengths in lengths.items():
        entries[host] = sorted(all_lengths)
    return entries


def suffixes(host: str, most_labels: int) -> list[str]:
    """The host and its parent domains of at most ``most_labels`` labels, the longest first."""
    out, at = [], len(host)
    for _ in range(most_labels):
        at = host.rfind(".", 0, at)
        out.append(host[at + 1 :])
        if at < 0:
            break
    return [s for s in reversed(out) if s]


@lru_cache(maxsize=4)
def _opened(array_name: str, strings_name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(array_name), SparkFiles.get(strings_name))


def judge(index: DigestArray, hosts: list[str], paths: list[str], most_labels: int) -> list[tuple[str | None, str | None]]:
    """The longest fitting rule and its verdict for each URL; of equal length, the longer host's."""
    distinct = {host: suffixes(host, most_labels) for host in set(hosts)}
    probes = sorted({s for all_suffixes in distinct.values() for s in all_suffixes})
    lengths = {s: found for s, found in zip(probes, index.find(probes)) if found is not None}
    wanted, owners = [], []
    for i, (host, path) in enumerate(zip(hosts, paths)):
        for suffix in distinct[host]:
            for n in lengths.get(suffix, ()):
                if n <= len(path):
                    wanted.append(suffix + path[:n])
                    owners.append((i, len(suffix)))
    best: dict[int, tuple] = {}
    for (i, host_length), text, verdict in zip(owners, wanted, index.find(wanted)):
        if isinstance(verdict, str):
            best[i] = max(best.get(i, (0, 0, None, None)), (len(text), host_length, text, verdict))
    return [best[i][2:] if i in best else (None, None) for i in range(len(hosts))]


def _by_array(urls: DataFrame, host: str, path: str, out: str, rules: list[tuple[str, str]]) -> DataFrame:
    name = f"url-rules-{uuid4().hex}"
    folder = tempfile.mkdtemp(prefix="url-rules-")  # handed to Spark, which ships the files
    files = [os.path.join(folder, name + ending) for ending in (".npy", ".json")]
    DigestArray.write(index_entries(rules), *files)
    for file in files:
        urls.sparkSession.sparkContext.addFile(file)
    most_labels = max(split_rule(rule)[0].count(".") + 1 for rule, _ in rules)

    @F.pandas_udf(VERDICT_TYPE)
    def verdicts(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        index = _opened(name + ".npy", name + ".json")
        return pd.DataFrame(judge(index, list(hosts), list(paths), most_labels), columns=["rule", "verdict"], dtype=object)

    return urls.withColumn(out, verdicts(host, path))


def _by_join(urls: DataFrame, host: str, path: str, out: str, rules: DataFrame) -> DataFrame:
    """The same through a join of distinct (host, path) pairs with the rules."""
    host_of = F.regexp_extract("rule", "^[^/]*", 0)
    listed = rules.select("rule", "verdict", host_of.alias("rule_host"), F.expr("char_length(rule)").alias("n"))
    by_host = listed.groupBy("rule_host").agg(F.collect_set(F.col("n") - F.char_length("rule_host")).alias("lengths"))
    pairs = urls.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    labels = F.split("h", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    probes = (
        pairs.withColumn("rule_host", suffix).join(by_host, "rule_host")
        .select("h", "p", "rule_host", F.explode("lengths").alias("length")).where(F.col("length") <= F.char_length("p"))
        .withColumn("rule", F.concat("rule_host", F.substring(F.col("p"), F.lit(1), F.col("length"))))
    )
    best = probes.join(listed.select("rule", "verdict", "n"), "rule").groupBy("h", "p").agg(
        F.max(F.struct("n", F.char_length("rule_host"), "rule", "verdict")).alias("best"))
    joined = urls.join(best, (F.col(host) == best.h) & (F.col(path) == best.p), "left")
    return joined.withColumn(out, F.struct(F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))).drop("h", "p", "best")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``pages`` with a struct column ``url_verdict`` (host, path, rule, verdict).

    ``rules`` has the columns rule (host, then a path that begins with a slash) and verdict; one rule
    twice with different verdicts keeps the smaller verdict (allow before block). A rule fits its host and
    subdomains when the path starts with the rule's; the longest rule wins. Without a rule the
    verdict is ``default`` and the rule null. A null URL, or one without ``://``, has an empty host
    and path and fits no rule. Null rules are left out. If ``url_verdict`` is taken, the name gets
    an underscore in front.
    """
    clean = rules.where("rule is not null and verdict is not null").groupBy("rule").agg(F.min("verdict").alias("verdict"))
    out, host, path = fresh(pages, "url_verdict"), fresh(pages, "url_host"), fresh(pages, "url_path")
    split = pages.withColumn(host, url_host(pages["url"])).withColumn(path, url_path(pages["url"]))
    size = clean.agg(F.sum(F.octet_length("rule") + 64)).first()[0] or 0
    if size == 0:
        judged = split.withColumn(out, F.lit(None).cast(VERDICT_TYPE))
    elif size <= max_index_bytes:
        judged = _by_array(split, host, path, out, [tuple(row) for row in clean.collect()])
    else:
        judged = _by_join(split, host, path, out, clean)
    verdict = F.struct(
        F.col(host).alias("host"), F.col(path).alias("path"), F.col(out)["rule"].alias("rule"),
        F.coalesce(F.col(out)["verdict"], F.lit(default)).alias("verdict"),
    )
    return judged.withColumn(out, verdict).select(*pages.columns, out)
