"""URL filters: a blocked Bloom filter of listed canonical URLs before an exact hash join.

A list entry is a canonical URL, host and path, with a verdict; it covers its host
and all subdomains where the path starts with its own.  The URLs that could be
listed for a page are few: its host and each parent domain, with the path cut at
each length that the list has.  Each is hashed to one block of the filter (eight
64-bit words) and one bit of every word; a page's candidate goes on only if its block
has all eight bits.  Possible hits then meet the list itself in an equi-join, so a
false positive of the filter never decides anything.  The longest entry wins (by
length of host and path, then of host; of equal entries, block).

All steps are DataFrame expressions.  The filter has a fixed number of blocks, so
its broadcast size is a parameter (MAX_BLOCKS, 64 bytes each); a list too long for it
only lets more candidates through to the join.

Null URLs and URLs without ``://`` have an empty host and path, and no entry
fits.  Repeated rows are judged alike; null ids are kept.  Empty tables give empty
results; an empty list fits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, BITS_PER_URL, MAX_BLOCKS = 8, 16, 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#``, A-Z lower-cased.  Path: then up to ``?``, ``#``."""
    rest = F.expr(f"if(instr(`{url}`, '://') > 0, substr(`{url}`, instr(`{url}`, '://') + 3), '')")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _block(name: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), F.col(name)), F.lit(blocks)).cast("int")


def _bits(name: str) -> list[Column]:
    """One bit for each word of the block, from six bits of a second hash each."""
    second = F.xxhash64(F.lit("bits"), F.col(name))
    return [_bit(second, i) for i in range(WORDS)]


def _bit(second: Column, i: int) -> Column:
    place = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def bloom(listed: DataFrame, name: str, blocks: int) -> DataFrame:
    """The filter as rows ``_block, _words``: the union of the bits of all entries, combined map-side."""
    marked = listed.select(_block(name, blocks).alias("_block"), *[b.alias(f"_w{i}") for i, b in enumerate(_bits(name))])
    whole = marked.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)])
    return whole.select("_block", F.array(*[f"_w{i}" for i in range(WORDS)]).alias("_words"))


def judged(pages: DataFrame, listed: DataFrame, url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``host``, ``path``, ``rule`` (the entry that fits, or null) and ``verdict`` of every page.

    ``listed`` has ``host``, ``path`` and ``verdict`` (allow or block).  A page that
    no entry covers is allowed.  Candidates are made once for each distinct host and
    path, and carry nothing else of the pages.
    """
    keep = keep or []
    host, path = host_and_path(url)
    # of equal entries, block ("block" is the larger text); a host has no slash, so the parts cannot be confused
    entries = listed.groupBy(F.concat("host", "path").alias("_entry")).agg(F.max("verdict").alias("_verdict"))
    size = entries.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    blocks = max(1, min(MAX_BLOCKS, -(-size * BITS_PER_URL // (64 * WORDS))))
    lengths = sorted(r[0] for r in listed.select(F.length("path")).distinct().collect())
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    sites = rows.select("host", "path").distinct()
    cut = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    parents = F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> substring_index(host, '.', -i))")
    candidates = (
        sites.filter("host <> ''").withColumn("_domain", F.explode(parents))
        .withColumn("_start", F.explode(F.array_compact(cut))).withColumn("_entry", F.concat("_domain", "_start"))
    )
    filter_ = bloom(entries, "_entry", blocks)
    possible = (
        candidates.withColumn("_block", _block("_entry", blocks)).join(F.broadcast(filter_), "_block")
        .filter(_has_all()).select("host", "path", "_domain", "_entry")
    )
    hits = possible.join(entries, "_entry")
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("_entry").alias("n"), F.length("_domain").alias("d"), F.col("_verdict").alias("verdict"), F.col("_entry").alias("entry"))).alias("_hit")
    )
    return rows.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in keep], "host", "path", F.col("_hit.entry").alias("rule"), F.coalesce(F.col("_hit.verdict"), F.lit("allow")).alias("verdict")
    )


def _has_all() -> Column:
    found = F.lit(True)
    for i, bit in enumerate(_bits("_entry")):
        found = found & (F.col("_words")[i].bitwiseAND(bit) == bit)
    return found
