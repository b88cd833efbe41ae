"""URL filters by a Bloom filter cascade.

The key of a URL (host and the head of its path that the rules can see) is
either listed for blocking or not. Level 1 of the cascade is a Bloom filter of
the listed keys; level 2 one of the unlisted keys of the corpus that pass
level 1; level 3 one of the listed keys that pass level 2; and so on until
nothing passes by mistake. The first level that a key fails decides. Over the
key universe the cascade was built on, which is every key of the corpus, the
answer is exact, and no join is needed to look a URL up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import mix
from haulwise.session import cut_lineage


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and the start of a path."""

    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text of the longest rule that fits, else null."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, r.text) if out is None else out.when(fits, r.text)
    return F.lit(None).cast("string") if out is None else out


def listed(host: Column, path: Column, rules: Sequence[Rule], labels: Sequence[str]) -> Column:
    """Whether a key is listed for blocking: its rule blocks, or none fits and
    one of the host's labels is listed."""
    rule = fitting_rule(host, path, rules)
    blocking = [r.text for r in rules if r.action == "block"]
    spam = F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, labels))) if labels else F.lit(False)
    return F.when(rule.isNotNull(), rule.isin(blocking) if blocking else F.lit(False)).otherwise(spam)


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, size: int, probes: int) -> np.ndarray:
    """Bit positions of each key at a level, an array (probes, keys)."""
    a = mix(h1 + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
    b = mix(h2 ^ a) | np.uint64(1)
    return np.stack([(a + np.uint64(k) * b) % np.uint64(size) for k in range(probes)])


def _passes(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def depth(levels: list[tuple[np.ndarray, int]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The number of levels each key passes before it fails one."""
    out = np.zeros(len(h1), np.int64)
    live = np.arange(len(h1))
    for k, (bits, probes) in enumerate(levels):
        live = live[_passes(bits, _positions(h1[live], h2[live], k, 64 * len(bits), probes))]
        out[live] += 1
    return out


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).view(np.uint64)
                 for c in ("_h1", "_h2"))


def build_cascade(keys: DataFrame, *, miss: float = 0.02) -> list[tuple[np.ndarray, int]]:
    """Levels of the cascade over ``keys`` (_h1, _h2, listed), each the words
    of a bit array and its number of probes. Key sets stay distributed; the
    driver gets the bit arrays, whose size :func:`filter_urls` bounds."""
    levels: list[tuple[np.ndarray, int]] = []

    def members(batches, levels=None):
        for batch in batches:
            h1, h2 = _hashes(batch)
            inside = np.asarray(batch.column(batch.schema.get_field_index("listed")), bool)
            odd = len(levels) % 2 == 1  # this level holds unlisted keys
            yield h1, h2, (inside != odd) & (depth(levels, h1, h2) == len(levels))

    while True:
        sofar = list(levels)

        def count(batches, sofar=sofar):
            n = sum(int(m.sum()) for _, _, m in members(batches, sofar))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

        n = keys.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
        if not n:
            return levels
        probes = max(1, round(-np.log2(miss)))
        size = -(-int(n * probes / np.log(2)) // 64) + 1  # words

        def fill(batches, sofar=sofar, probes=probes, size=size):
            bits = np.zeros(size, np.uint64)
            for h1, h2, m in members(batches, sofar):
                at = _positions(h1[m], h2[m], len(sofar), 64 * size, probes).ravel()
                np.bitwise_or.at(bits, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
            some = np.flatnonzero(bits)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(bits[some].view(np.int64))], names=["word", "bits"])

        rows = keys.mapInArrow(fill, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
        bits = np.zeros(size, np.uint64)
        bits[rows.word.to_numpy(np.int64)] = rows.bits.to_numpy(np.int64).view(np.uint64)
        levels.append((bits, probes))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], labels: Sequence[str] = (), *, miss: float = 0.02,
                most_keys: int = 20_000_000) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per row of ``pages``
    (page_id, url; further columns are ignored).

    ``rule`` is the longest of ``rules`` that fits, else null. ``verdict`` is
    block for keys in the cascade's list, else allow: a URL with a rule gets
    the rule's action, one without is blocked when a label of its host is in
    ``labels``. Null urls and urls without ``://`` have empty host and path
    and are allowed. ``most_keys`` bounds one cascade's listed keys, and with
    ``miss`` its size (about 20 MB at the defaults); a longer list is cut by
    key hash into several cascades, each asked about its own URLs only.
    """
    head = max([len(r.path) for r in rules], default=0)
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    key = F.concat_ws("/", "host", F.substring("path", 1, head)) if head else F.col("host")
    hashes = {"_h1": F.xxhash64(key), "_h2": F.xxhash64(F.lit("second"), key)}
    keyed = parsed.withColumns(hashes)
    keys = cut_lineage(
        keyed.withColumn("path", F.substring("path", 1, head)).select("host", "path", "_h1", "_h2").distinct()
        .select("_h1", "_h2", listed(F.col("host"), F.col("path"), rules, labels).alias("listed")), "url-keys")
    n = keys.where("listed").count()
    parts = max(1, -(-n // most_keys))
    out = None
    schema = "page_id long, host string, path string, listed boolean"
    for part in range(parts):
        mine = F.pmod("_h1", F.lit(parts)) == part
        levels = build_cascade(keys.where(mine), miss=miss)

        def ask(batches, levels=levels):
            for batch in batches:
                inside = depth(levels, *_hashes(batch)) % 2 == 1
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in range(3)), pa.array(inside)], names=["page_id", "host", "path", "listed"])

        told = keyed.where(mine).select("page_id", "host", "path", "_h1", "_h2").mapInArrow(ask, schema)
        out = told if out is None else out.unionByName(told)
    return out.select("page_id", "host", "path", fitting_rule(F.col("host"), F.col("path"), rules).alias("rule"),
                      F.when(F.col("listed"), "block").otherwise("allow").alias("verdict"))
