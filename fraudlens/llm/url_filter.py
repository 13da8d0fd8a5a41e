"""Verdicts on page URLs by a list of rules, through a blocked Bloom filter.

A listed URL (a rule) is a host and the start of a path; it fits that host and its
subdomains where the path begins so.  Both sides are brought to one form: the host in
lower case (A-Z), the path without query and fragment.  A URL can only be listed under
an end of its host (whole labels) and a start of its path, and only under such as some
listed URL has the shape of (number of labels, length of the path): these are its keys.

The listed URLs make a blocked Bloom filter: a hash picks a block of eight 32-bit words, a
second one a bit in each of them.  The blocks are a small table, joined to the keys by the
block's number: a key whose eight bits aren't all set isn't listed, and goes no further.
What is left, possible hits, is joined by its text to the list, which removes false
positives.  Of the rules that fit a URL the longest one (host and path) wins, of
equally long ones that of the longer host.  Where none fits, ``default`` is the verdict.

All of it is DataFrame functions.  The blocks are broadcast up to BROADCAST_BYTES, known from
the number of rules, else keys and blocks are joined by a shuffle; so are long lists and
the decisions on URLs, which are measured.  Decisions are made once for each different
URL, so a URL that a third of the pages share costs no more than another one.

Results in odd cases: a null URL, or one without ``://``, has an empty host and path and the
default verdict; a null id stays; repeated rows are judged each; an empty table of pages
gives an empty result, no rules the default everywhere; a rule without a host, or of
another verdict than allow or block, is an error; a rule listed twice is one, listed
with both verdicts it blocks; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import written
from fraudlens.operators.joins import checked_broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the filter for each listed URL, and words of a block.
BITS_PER_RULE = 16
WORDS = 8
#: The blocks are broadcast up to this size; a row of them takes about BLOCK_BYTES.
BROADCAST_BYTES = 64_000_000
BLOCK_BYTES = 120
VERDICTS = ("allow", "block")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("rule_host", "rule_path"), F.lit(blocks))


def _masks() -> list[Column]:
    """A bit in each word of the block, of a hash apart from the block's."""
    bits = F.xxhash64("rule_path", F.lit(1), "rule_host")
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(WORDS)]


def canonical_rules(rules: DataFrame) -> DataFrame:
    """rule_host, rule_path and verdict of each rule, once."""
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    ok = (host != "") & F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))
    checked = rules.select(
        host.alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"),
        F.when(F.assert_true(ok, F.lit("a rule needs a host and the verdict allow or block")).isNull(), F.col("verdict")).alias("verdict"),
    )
    return checked.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))  # block is the larger


def bloom_blocks(rules: DataFrame, blocks: int) -> DataFrame:
    """block and its words w0 .. w7."""
    words = [F.bit_or(m).alias(f"w{i}") for i, m in enumerate(_masks())]
    return rules.groupBy(_block(blocks).alias("block")).agg(*words)


def keys_of(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """host, path, and each key (rule_host, rule_path) that a listed URL of some shape
    could have."""
    known = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(c).alias("chars")) for n, c in shapes])
    every = urls.withColumn("_labels", _labels(F.col("host"))).where("host <> ''").select("host", "path", "_labels", F.explode(known).alias("s"))
    fits = every.where("s.labels <= _labels AND s.chars <= length(path)")
    end = F.expr("substring_index(host, '.', -s.labels)")
    return fits.select("host", "path", end.alias("rule_host"), F.expr("substring(path, 1, s.chars)").alias("rule_path"))


def possible_hits(keys: DataFrame, rules: DataFrame, count: int) -> DataFrame:
    """The keys that the filter of ``rules`` lets pass: all that are listed, and few others."""
    blocks = max(1, -(-count * BITS_PER_RULE // (32 * WORDS)))
    table = bloom_blocks(rules, blocks)
    table = F.broadcast(table) if blocks * BLOCK_BYTES <= BROADCAST_BYTES else table.hint("shuffle_hash")
    passed = F.lit(True)
    for i, mask in enumerate(_masks()):
        passed = passed & (F.col(f"w{i}").bitwiseAND(mask) != 0)
    return keys.withColumn("block", _block(blocks)).join(table, "block").where(passed).select(keys.columns)


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The id, host, path, rule (host and path; null if none fits) and verdict of each
    page.  ``rules`` has columns host, path and verdict (allow or block)."""
    if default not in VERDICTS:
        raise ValueError(f"the default verdict is one of {VERDICTS}")
    listed = written(canonical_rules(rules), "rules")
    urls = pages.select(F.col(id_col).alias(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    # shapes are few: as many as numbers of labels and lengths of paths occur together
    shapes = listed.select(_labels(F.col("rule_host")).alias("n"), F.length("rule_path").alias("c")).distinct().collect()
    if not shapes:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    hits = possible_hits(keys_of(urls.select("host", "path"), [(r.n, r.c) for r in shapes]), listed, listed.count()).distinct()
    exact = hits.join(checked_broadcast(listed), ["rule_host", "rule_path"])
    longest = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"))
    best = F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), longest)
    decided = written(exact.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.*"), "decided")
    return urls.join(checked_broadcast(decided), ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
