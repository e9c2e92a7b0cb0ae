"""URL filter: a blocked Bloom filter of the listed keys lets possible hits through to an exact hash join.

The list holds domain rules (host and path prefix, allow or block) and canonical URLs (block). Every distinct URL is
turned into the keys it could be listed under: its canonical form, and one (host suffix, path prefix) pair for every
shape the rules have. Keys that the Bloom filter rejects go no further; the rest are joined with the list itself, which
removes the filter's false positives. Of the rules that fit, the longest wins.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed. Rules with
an empty host fit nothing. Of equally long rules the smaller string counts, of equal rules ``block``. Repeated rows
of pages are judged alike, each in its own output row. Columns of ``pages`` other than id and URL are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
BITS_PER_KEY = 16
WORDS = 8  # of 64 bits each in a block
BROADCAST_BYTES = 8 << 20
MAX_SHAPES = 4096


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?`` or ``#``, in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host, path and sorted query without scheme, default port, closing slashes, tracking parameters and fragment."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    host = F.regexp_replace(url_host(url), ":(80|443)$", "")
    path = F.regexp_replace(url_path(url), "/+$", "")
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _bit(key: Column, word: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 6 * word).bitwiseAND(F.lit(63)).cast("int")


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per non-empty block of 512 bits; a key sets one bit in each of its block's eight words."""
    one = F.lit(1).cast("long")
    words = [F.bit_or(F.call_function("shiftleft", one, _bit(F.col("key"), i))).alias(f"w{i}") for i in range(WORDS)]
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")
    return keys.groupBy(block).agg(*words)


def may_contain(probes: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The probes whose bits are all set. The filter is broadcast only while its size is within the bound."""
    if blocks * WORDS * 8 <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    joined = probes.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).join(bloom, "block")
    test = F.lit(True)
    for i in range(WORDS):
        test = test & (F.call_function("shiftright", F.col(f"w{i}"), _bit(F.col("key"), i)).bitwiseAND(F.lit(1)) == 1)
    return joined.filter(test).select(*probes.columns)


def judge_urls(
    pages: DataFrame, rules: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Host, path, rule and verdict of every page.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``); ``listed`` has ``canonical``, see
    ``canonical_url``. Returns id, ``host``, ``path``, ``rule`` (null without a fitting rule), ``verdict`` and ``listed``
    (the canonical URL is on the list). A page without a rule is blocked if it is listed.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    entries = (
        rules.filter(F.coalesce(F.col("host"), F.lit("")) != "")
        .select(F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))).alias("rule"), "verdict",
                F.size(F.split("host", r"\.")).alias("labels"), F.length(F.coalesce("path", F.lit(""))).alias("depth"))
        .select(F.concat(F.lit("r:"), "rule").alias("key"), "rule", "verdict", "labels", "depth")
        .unionByName(listed.filter("canonical IS NOT NULL").select(
            F.concat(F.lit("u:"), "canonical").alias("key"), F.lit(None).cast("string").alias("rule"),
            F.lit("block").alias("verdict"), F.lit(None).cast("int").alias("labels"), F.lit(None).cast("int").alias("depth")))
        .groupBy("key", "rule", "labels", "depth").agg(F.max("verdict").alias("verdict"))
    )
    size = entries.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("key") + 48), F.lit(0)).alias("b")).head()
    shapes = entries.filter("labels IS NOT NULL").select("labels", "depth").distinct().limit(MAX_SHAPES + 1).collect()
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"rules of more than {MAX_SHAPES} shapes (labels of the host, length of the path)")
    blocks = max(1, -(-size["n"] * BITS_PER_KEY // (64 * WORDS)))

    urls = rows.select("_url").filter("_url IS NOT NULL").distinct()
    host, path = url_host(F.col("_url")), url_path(F.col("_url"))
    keys = [F.concat(F.lit("u:"), canonical_url(F.col("_url")))] + [
        F.concat(F.lit("r:"), F.substring_index(host, ".", -s["labels"]), F.substring(path, 1, s["depth"])) for s in shapes
    ]
    probes = urls.select("_url", F.explode(F.array_distinct(F.array(*keys))).alias("key"))
    possible = may_contain(probes, bloom_filter(entries.select("key"), blocks), blocks)
    entry = entries.select("key", "rule", F.col("verdict").alias("_verdict"))
    exact = possible.join(F.broadcast(entry) if size["b"] <= BROADCAST_BYTES else entry, "key")
    best = F.min(F.when(F.col("rule").isNotNull(), F.struct(
        (-F.length("rule")).alias("l"), F.col("rule").alias("rule"), F.col("_verdict").alias("verdict"))))
    hits = exact.groupBy("_url").agg(best.alias("_best"), F.max(F.col("rule").isNull()).alias("_listed"))
    found = F.coalesce(F.col("_listed"), F.lit(False))
    return rows.join(hits, "_url", "left").select(
        F.col("_id").alias(id_col), url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.when(found, "block").otherwise("allow")).alias("verdict"), found.alias("listed"))


def recaptured(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Canonical URLs under which more than one page was captured."""
    return (
        pages.filter(F.instr(F.col(url_col), "://") > 0).groupBy(canonical_url(F.col(url_col)).alias("canonical"))
        .agg(F.count("*").alias("n")).filter("n > 1").select("canonical")
    )
