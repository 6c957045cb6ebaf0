"""URL filters: pattern rules are indexed by their rarest literal token, and URL tokens fetch the rules to try.

Only DataFrame functions are used.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates tokens in a folded URL.
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: More rules than this are joined by a shuffle instead of being shipped.
SHIPPED_RULES = 100_000
#: Copies of a repeated row that are rebuilt together.
PART_COPIES = 10_000


@dataclass(frozen=True)
class UrlRule:
    """One rule. ``regex`` is tested on host + path; ``literals`` are folded tokens every URL it fits must hold."""

    name: str
    verdict: str
    rank: int
    regex: str
    literals: tuple[str, ...]
    folded: bool = False  # test the path with A-Z lower-cased


def host_rule(host: str, path: str, verdict: str) -> UrlRule:
    """A rule for a host, its subdomains and a path prefix; the longer its text, the higher its rank."""
    fold = str.maketrans(_UPPER, _LOWER)
    tokens = [t for t in re.split(_SEPARATOR, host.translate(fold)) if t]
    inner = re.split(_SEPARATOR, path.translate(fold))
    tokens += [t for t in inner[:-1] if t]  # what follows the last separator may go on in the URL
    return UrlRule(host + path, verdict, 1000 + len(host + path), rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(tokens))


def pattern_rule(pattern: str, verdict: str = "block") -> UrlRule:
    """A rule in the usual filter-list notation.

    ``||`` stands for the start of the host or of one of its labels, ``^`` for a
    separator or the end, ``*`` for anything, a last ``|`` for the end.
    Literal tokens are those with a separator, ``^`` or an anchor at both sides.
    """
    body, head = pattern, ""
    if body.startswith("||"):
        body, head = body[2:], r"^([^/]*\.)?"
    tail = ""
    if body.endswith("|"):
        body, tail = body[:-1], "$"
    parts = {"*": ".*", "^": r"([^0-9a-z]|$)"}
    regex = head + "".join(parts.get(c) or re.escape(c) for c in body) + tail
    marked = ("." if head else "*") + body + ("." if tail else "*")
    literals = re.findall(r"(?<=[^0-9a-z*\x80-\U0010ffff])[0-9a-z\x80-\U0010ffff]+(?=[^0-9a-z*\x80-\U0010ffff])", marked)
    return UrlRule(pattern, verdict, len(pattern), regex, tuple(literals), True)


#: The method's own rules for URLs that no listed host rule decides.
PATTERNS = (
    "||spam-farm.", "||spamfarm.", "||linkfarm.", "||link-farm.", "||casino.", "||poker.", "||adult.", "||xxx.", "||porn.",
    "||warez.", "||torrent.", "||malware.", "||phishing.", "||ads.", "||adserver.", "||doubleclick.", "||tracker.",
    "||tracking.", "||banner.", "||popup.", "||clickbait.", "||payday-loans.", "||viagra.", "||replica-watches.",
    "-casino.", "-porn.", "-xxx.", "-poker.", "spam-farm", "/casino/", "/porn/", "/xxx/", "/adult/", "/warez/",
    "/torrent/", "/viagra/", "/popup/", "/adserver/", "/wp-login.php", "/xmlrpc.php", "/cgi-bin/", "/cart/checkout/",
    ".exe|", ".apk|", ".dmg|", ".msi|",
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The deciding rule of every page's URL: page_id, host, path, rule, verdict (both null where no rule fits).

    The highest rank wins, then the smaller name. Host and path are matched as
    one folded string. One shuffle carries one row per distinct (id, URL);
    repeated rows are counted there and come back as often. A rule sits under
    the token that the fewest URLs hold (counts over all URLs, of rule tokens
    only), so a token of a third of all URLs fetches just the rules that have
    no rarer one. Rules without a literal token are tried on every URL. Null
    ids and URLs are kept; an empty table or rule list is fine.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    urls = (
        pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"))
        .groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("host", host).withColumn("path", path)
        .withColumn("place", F.concat("host", F.translate("path", _UPPER, _LOWER)))
        .withColumn("exact", F.concat("host", "path"))
        .withColumn("tokens", F.array_distinct(F.concat(
            F.array(F.lit("")), F.filter(F.split("place", _SEPARATOR), lambda t: t != ""))))
    )
    table = spark.createDataFrame(
        [(r.name, r.verdict, r.rank, r.regex, r.folded, list(r.literals) or [""], n) for n, r in enumerate(rules)],
        "rule string, verdict string, rank int, regex string, folded boolean, literals array<string>, n int",
    )
    small = len(rules) <= SHIPPED_RULES
    ship = F.broadcast if small else (lambda df: df)
    wanted = table.select(F.explode("literals").alias("token")).distinct()
    held = urls.select(F.explode("tokens").alias("token")).join(ship(wanted), "token", "left_semi")
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    keyed = (
        table.withColumn("token", F.explode("literals"))
        .join(ship(counts), "token", "left")
        .groupBy("n").agg(
            F.min_by("token", F.struct(F.coalesce("held", F.lit(0)), "token")).alias("token"),
            *[F.first(c).alias(c) for c in ("rule", "verdict", "rank", "regex", "folded")],
        )
    )
    index = keyed.groupBy("token").agg(F.collect_list(F.struct("rank", "rule", "verdict", "regex", "folded")).alias("candidates"))
    tried = urls.withColumn("token", F.explode("tokens")).join(ship(index), "token", "left")
    fits = F.filter("candidates", lambda r: F.rlike(F.when(r["folded"], F.col("place")).otherwise(F.col("exact")), r["regex"]))
    # The least (-rank, name) is the winner; min skips the tokens that fetched nothing.
    best = F.array_min(F.transform(fits, lambda r: F.struct((-r["rank"]).alias("order"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    judged = (
        tried.select("page_id", "url", "copies", "host", "path", best.alias("best"))
        .groupBy("page_id", "url").agg(F.min("best").alias("best"), *[F.first(c).alias(c) for c in ("copies", "host", "path")])
    )
    # A row that repeats very often comes back in parts, dealt out before they are rebuilt.
    parts = judged.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / PART_COPIES).cast("int"))))
    size = F.least(F.lit(PART_COPIES), F.col("copies") - F.col("part") * PART_COPIES).cast("int")
    dealt = parts.withColumn("size", size).repartition("page_id", "host", "part")
    return dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("size")))).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")
    )
