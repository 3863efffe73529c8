r"""URL filtering with redirect equivalence.

Method: pages name other addresses by canonical links and by refreshes. Addresses joined by such edges
are aliases: connected components over the edges, computed by Spark joins, carry a block from any
address to all of its aliases. An address with a rule of its own keeps that rule's verdict, so an explicit
allow takes precedence over a block that comes through an alias; it does not clear its aliases.

A rule is ``host/path``. It fits its host and all subdomains if the address's path starts with the
rule's path; the longest fitting rule counts.

Defined results: a null address, or one without ``://``, has empty host and path, no rule and no aliases
and is allowed. A null or empty html names nothing. Equal addresses on several rows get equal verdicts,
each row its own. Unknown addresses that pages name take part: a page whose canonical link is blocked
is blocked. A page may have any number of links. Links are followed without dot segments being
resolved; a fragment is no part of an address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.llm.graph import components
from tripforge.staging import stage

ALLOW, BLOCK = "allow", "block"

# Each pattern is tried once at a place and, being possessive or anchored, never goes back over what it has read: time
# follows a page's length, whatever it holds.
_TAGS = r"(?i)<(?:link|meta)\b[^>]*+>"
_HREF = r"""(?i)\bhref\s*+=\s*+["']?([^"'\s>]++)"""
_TO = r"""(?i)\burl\s*+=\s*+["']?([^"'\s>;]++)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """The address that links are compared by: lower-cased scheme and host, no fragment."""
    start = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(start != "", F.concat(_lower(start), rest))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null. ``rules``: (verdict, host/path)."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last ``when`` put around the others is asked first: the longest rule.
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own_host, _, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _tags(html: Column) -> Column:
    """All link and meta tags. Nothing after the last bracket is one, so each that begins is closed."""
    markup = html.cast("string")
    rest = F.length(F.substring_index(markup, ">", -1))
    return F.regexp_extract_all(F.substring(markup, F.lit(1), F.length(markup) - rest), F.lit(_TAGS), F.lit(0))


def _is_canonical(tag: Column) -> Column:
    """Whether some ``rel=`` is followed by the word canonical before a quote other than its own opening one."""
    parts = F.split(tag, "[\"']")

    def named(part: Column, place: Column) -> Column:
        before = F.regexp_extract(part, r"(?is)^(.*)\bcanonical\b", 1)
        opened = (place > 0) & F.coalesce(F.get(parts, place - 1).rlike(r"(?i)\brel\s*+=\s*+$"), F.lit(False))
        return part.rlike(r"(?i)\bcanonical\b") & (opened | before.rlike(r"(?i)\brel\s*+="))

    said = F.transform(parts, named)
    return tag.rlike("(?i)^<link") & F.exists(said, lambda x: x)


def _is_refresh(tag: Column) -> Column:
    return tag.rlike("(?i)^<meta") & tag.rlike(r"""(?i)\bhttp-equiv\s*+=\s*+["']?refresh\b""")


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) between addresses, from the canonical links and refreshes of each page."""
    tags = pages.select(F.col(f"`{url}`").cast("string").alias("url"), F.explode(_tags(F.col(f"`{html}`"))).alias("tag"))
    tag = F.col("tag")
    named = F.when(_is_canonical(tag), F.regexp_extract(tag, _HREF, 1)).when(
        _is_refresh(tag), F.regexp_extract(tag, _TO, 1)
    )
    said = tags.select("url", F.replace(named, F.lit("&amp;"), F.lit("&")).alias("ref")).where("ref <> ''")
    here = F.col("url")
    start = F.regexp_extract(here, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(here, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(folder.endswith("/") & (folder != start), folder).otherwise(F.concat(folder, F.lit("/")))
    ref = F.col("ref")
    whole = (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), ref)
        .when(ref.startswith("//"), F.concat(F.regexp_extract(here, r"(?s)^(.*?:)//", 1), ref))
        .when(ref.startswith("/"), F.concat(start, ref))
        .when(ref.startswith("?"), F.concat(start, path_of(here), ref))
        .when(~ref.startswith("#"), F.concat(folder, ref))
    )
    return said.select(address(here).alias("a"), address(whole).alias("b")).where("a <> b")


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    keep: list[str],
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """The ``keep`` columns of every page with host, path, rule, verdict and reason.

    ``reason`` is rule, alias (blocked through a link) or default.
    """
    edges = stage(links(pages, url, html), "url-links")
    nodes = stage(components(edges, "url-components"), "url-nodes")
    own = best_rule(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
    blocked = nodes.groupBy("component").agg(F.max(F.coalesce(own == BLOCK, F.lit(False))).alias("blocked"))
    aliases = nodes.join(blocked.where("blocked"), "component").select("node", F.lit(True).alias("blocked"))

    place = F.col(f"`{url}`").cast("string")
    judged = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
        address(place).alias("node"),
        host_of(place).alias("host"),
        path_of(place).alias("path"),
    ).withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    through = F.coalesce("blocked", F.lit(False))
    return judged.join(aliases, "node", "left").select(
        *[F.col("kept")[c].alias(c) for c in keep],
        "host",
        "path",
        F.col("best")["rule"].alias("rule"),
        F.coalesce(F.col("best")["verdict"], F.when(through, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.when(F.col("best").isNotNull(), "rule").when(through, "alias").otherwise("default").alias("reason"),
    )
