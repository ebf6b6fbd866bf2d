"""URL verdicts from host/path rules and a list of canonical URLs.

The list is held as a blocked Bloom filter.  A URL that the filter rejects is
surely not listed; the rest meet the list in an exact hash join, which removes
the false positives.  Everything is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.llm import bloom
from vireo.llm.common import fresh

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Host labels that name the same site.
SITE_ALIASES = r"^(?:(?:www|m|amp)\.)+"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Scheme, query, fragment, site aliases, default port, closing dot and closing slash removed; null without a host."""
    site = F.regexp_replace(F.regexp_replace(host, SITE_ALIASES, ""), r"\.?(?::(?:80|443))?$", "")
    return F.when(host != "", F.concat(site, F.regexp_replace(path, r"/+$", "")))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule (struct verdict, name) that fits, else null; of rules as long as each other the first by name.

    A rule fits its host and all subdomains if the path starts with its path.
    ``rules`` is a parameter of the call, not data.
    """
    best = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict))
    fits = [F.when((F.concat(F.lit("."), host).endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.name).alias("name"))) for r in best]
    return F.coalesce(*fits, F.lit(None).cast("struct<verdict:string,name:string>"))


def listed(df: DataFrame, key: str, entries: DataFrame, entry: str, flag: str = "listed") -> DataFrame:
    """``df`` with the boolean ``flag``: whether the value of ``key`` occurs in ``entries.entry``.

    Bloom filter first (a fixed number of bytes is broadcast), then an exact
    join of the possible hits; a null key is not listed, null entries count
    for nothing, and an empty list lists nothing.  Repeated rows stay repeated.
    """
    known = entries.filter(F.col(entry).isNotNull()).select(F.col(entry).alias(fresh("entry", df.columns))).distinct()
    name = known.columns[0]
    blocks = bloom.blocks_for(known.count())
    maybe = fresh("maybe", df.columns)
    probed = bloom.maybe(df, F.col(key), bloom.build(known, name, blocks), blocks, maybe)
    hits = probed.filter(F.col(maybe)).join(known, F.col(key) == F.col(name), "left")
    hits = hits.select(*df.columns, F.col(name).isNotNull().alias(flag))
    return probed.filter(~F.col(maybe)).select(*df.columns, F.lit(False).alias(flag)).unionByName(hits)


def judge(pages: DataFrame, rules: list[Rule], entries: DataFrame | None = None, entry: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, canonical) of every page.

    The longest rule decides.  Where none fits, a page whose canonical URL is
    in ``entries`` (canonical URLs) is blocked and any other is allowed.
    Without ``entries`` the list is the canonical URLs that a block rule hits,
    so another spelling of a blocked URL is blocked too.  Null and hostless
    URLs have empty host and path, no rule, and are allowed.  Columns other
    than page_id and url are not read.
    """
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = split.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("canonical", canonical(F.col("host"), F.col("path")))
    if entries is None:
        entries, entry = judged.filter(F.col("hit.verdict") == "block").select("canonical"), "canonical"
    marked = listed(judged, "canonical", entries, entry)
    return marked.select("page_id", "host", "path", F.col("hit.name").alias("rule"),
                         F.coalesce(F.col("hit.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "canonical")
