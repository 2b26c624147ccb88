"""URL filtering with DataFrame functions only: rules, a blocked Bloom filter, an exact hash join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.sources.scratch import cut_lineage

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
WORDS, BITS = 8, 8  # a block is 8 words of 64 bits; each listed URL sets one bit in each
PER_URL = 16  # filter bits for each listed URL
MAX_BLOCKS = 1 << 16  # 4 MB of filter at most; a longer list only lets more URLs on to the exact join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ://, or null."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """host/path?parameters of one spelling: no scheme, fragment, leading www., final / or tracking
    parameters, and the other parameters sorted. Empty where the host is."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]*|ref)="))
    params = F.array_join(F.array_sort(kept), "&")
    return F.when(host == "", "").otherwise(F.concat(host, path, F.when(params == "", "").otherwise(F.concat(F.lit("?"), params))))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    same = (host == rule[0]) | F.endswith(host, F.lit("." + rule[0]))
    return same & F.startswith(path, F.lit(rule[1]))


def with_rule(rows: DataFrame, rules: tuple) -> DataFrame:
    """Columns rule and rule_verdict: those of the longest rule that fits (a tie: the first by text)."""
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    host, path = F.col("host"), F.col("path")

    def first(value) -> Column:
        none = F.lit(None).cast("string")
        return reduce(lambda rest, r: F.when(_fits(host, path, r), F.lit(value(r))).otherwise(rest), reversed(ranked), none)

    return rows.withColumns({"rule": first(lambda r: r[0] + r[1]), "rule_verdict": first(lambda r: r[2])})


def _place(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """(block number, one mask per word): the bits of a URL."""
    block, bits = F.pmod(F.xxhash64(url), F.lit(blocks)), F.xxhash64(url, F.lit(1))
    places = [F.shiftrightunsigned(bits, i * BITS).bitwiseAND(63).cast("int") for i in range(WORDS)]
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return block, masks


def blocked_bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7): the filter of column ``canonical``, one row per block that is not empty.

    Masks combine by bit_or map-side, so a task sends each block once at most.
    """
    block, masks = _place(F.col("canonical"), blocks)
    bits = listed.select(block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def url_verdicts(
    pages: DataFrame, listed: DataFrame, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    The longest rule that fits decides. Where none does, a URL is blocked if its canonical form is
    that of a URL in ``listed``, and allowed otherwise. The list becomes a blocked Bloom filter, of
    at most ``MAX_BLOCKS`` rows, which is broadcast; a URL whose eight bits are all set is a possible
    hit, and only those go on to a hash join with the exact list, which removes the false ones. All
    others are settled without a shuffle.

    A null URL or one without :// has an empty host and path, fits no rule and is on no list. Repeated
    rows and URLs, on either side, count as they are. An empty list blocks nothing.
    """
    url = F.col(url_col)
    rows = with_rule(pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                                  canonical(url).alias("canonical")), rules)
    exact = cut_lineage(listed.select(canonical(F.col(url_col)).alias("canonical")).where("canonical != ''").distinct())
    blocks = max(1, min(MAX_BLOCKS, exact.count() * PER_URL // (64 * WORDS) + 1))
    filter_ = F.broadcast(blocked_bloom(exact, blocks))
    block, masks = _place(F.col("canonical"), blocks)
    probed = rows.withColumn("block", F.when(F.col("rule").isNull(), block)).join(filter_, "block", "left")
    missing = [m.bitwiseAND(F.bitwise_not(F.col(f"w{i}"))) for i, m in enumerate(masks)]
    all_set = reduce(lambda a, b: a.bitwiseOR(b), missing) == 0
    probed = probed.withColumn("possible", F.coalesce(all_set, F.lit(False)))
    hits = probed.where("possible").join(exact.withColumn("on_list", F.lit(True)), "canonical", "left")
    settled = probed.where("NOT possible").withColumn("on_list", F.lit(None).cast("boolean"))
    columns = ["page_id", "host", "path", "rule", "rule_verdict", "on_list"]
    every = hits.select(columns).unionByName(settled.select(columns))
    method = F.when(F.col("on_list"), "block").otherwise("allow")
    return every.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"))


#: Sites whose pages make up the list of the registered query.
LISTED_SITES = ("spam-farm", "casino-win", "cheap-pills")


def listed_pages(pages: DataFrame, sites: tuple[str, ...] = LISTED_SITES) -> DataFrame:
    """The URLs of ``pages`` on a listed site, that is with one of the names as a label of their host."""
    return pages.where(F.arrays_overlap(F.split(host_of(F.col("url")), r"\."), F.array(*map(F.lit, sites)))).select("url")


_HOST = "translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, coalesce({_HOST}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '') AS query FROM cut
), named AS (
  SELECT page_id, host, path, CASE WHEN host_name = '' THEN '' ELSE host_name || regexp_replace(path, '/+$', '')
    || CASE WHEN params = '' THEN '' ELSE '?' || params END END AS canonical
  FROM (SELECT *, regexp_replace(host, '^www\\.', '') AS host_name, coalesce(array_to_string(list_sort(list_filter(
    string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]*|ref)='))), '&'), '') AS params FROM parts)
), listed AS (
  SELECT DISTINCT canonical FROM named WHERE canonical <> ''
    AND list_has_any(string_split(host, '.'), ['spam-farm', 'casino-win', 'cheap-pills'])
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM named
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
