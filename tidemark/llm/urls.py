"""URL verdicts by site and pattern rules, each rule indexed by its rarest literal token.

A site rule ``host/path`` fits its host and all subdomains where the URL's path starts with the rule's. A pattern
rule is literal text with ``*`` for anything, ``^`` for a separator or the end, ``||`` at its start for the start of
any host label and ``|`` at an end for that end of the address. Only DataFrame functions are used.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import salted_join

from .batches import stored

#: Rule bytes up to which the index goes to every task as one value; larger lists are joined by token.
INDEX_BYTES = 8 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A literal run whose neighbours in the rule are literal too: a URL that fits has it as a whole token.
WHOLE_TOKEN = r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"
LABEL_START = r"^(?:[^/?#]*\.)?"
SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\A|\z)"

#: Host names and paths of spam, betting, advertising and tracking.
BLOCK_PATTERNS = (
    "||ads-track.", "||casino-win.", "||cheap-pills.", "||free-bets.", "||spam-farm.", "||adult-x.",
    "||adserver.", "||doubleclick.", "||malware.", "||phishing.", "/adserver/", "/doorway/*.html|", "^click-farm^",
)


def rules_table(spark: SparkSession, sites: Iterable[tuple[str, str]] = (), patterns: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """Rules of the given (text, verdict) pairs, as ``judge`` takes them."""
    rows = [F.struct(F.lit(r), F.lit(True), F.lit(v)) for r, v in sites] + [F.struct(F.lit(r), F.lit(False), F.lit(v)) for r, v in patterns]
    kind = "array<struct<rule:string,site:boolean,verdict:string>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def _low(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def address(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and all that follows the host; empty without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return _low(host), path, F.regexp_extract(after, r"(?s)^[^/?#]*(.*)$", 1)


def _tokens(text: Column) -> Column:
    """Distinct tokens of an address; the empty one fetches the rules that have no whole token."""
    return F.array_append(F.array_distinct(F.regexp_extract_all(_low(text), F.lit("[a-z0-9]+"), F.lit(0))), F.lit(""))


def compiled(rules: DataFrame) -> DataFrame:
    """Rules with their regular expression, whole literal tokens and rank; repeated and null rules are left out.

    Rank orders the rules that fit one URL: site rules by length, then allowing patterns, then blocking ones.
    """
    known = rules.select("rule", "site", "verdict").where("rule is not null and site is not null and verdict in ('allow', 'block')").distinct()
    host = F.substring_index("rule", "/", 1)
    site = F.concat(_low(host), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)"))
    text = F.when(F.col("site"), F.concat(F.lit("||"), site)).otherwise(F.col("rule"))
    body = F.when(F.col("site"), site).otherwise(F.regexp_replace(text, r"^\|\|?|\|$", ""))
    quoted = F.regexp_replace(body, r"([\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])", r"\\$1")
    opened = F.regexp_replace(F.regexp_replace(quoted, r"\\\*", ".*"), r"\\\^", F.lit(SEPARATOR.replace("\\", "\\\\")))
    start = F.when(text.startswith("||"), F.lit(LABEL_START)).when(text.startswith("|"), F.lit("^")).otherwise(F.lit(""))
    whole_host = F.col("site") & (F.instr("rule", "/") == 0)
    end = F.when(whole_host, F.lit(r"(?=/|\z)")).when(~F.col("site") & F.col("rule").endswith("|"), F.lit(r"\z")).otherwise(F.lit(""))
    regex = F.concat(
        F.when(F.col("site"), F.lit("(?s)")).otherwise(F.lit("(?si)")), start, F.when(F.col("site"), quoted).otherwise(opened), end
    )
    rank = F.when(F.col("site"), F.length("rule") + 2).when(F.col("verdict") == "allow", F.lit(1)).otherwise(F.lit(0))
    ended = F.when(whole_host, F.concat(text, F.lit("/"))).otherwise(text)
    whole = F.array_distinct(F.regexp_extract_all(_low(ended), F.lit(WHOLE_TOKEN), F.lit(0)))
    return known.select("rule", "site", "verdict", regex.alias("regex"), rank.alias("rank"), whole.alias("tokens"))


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Compiled rules with the one token they are fetched by: of their whole tokens the one fewest URLs have.

    ``urls`` holds addresses in ``_address``. All URLs are counted, combined before the shuffle.
    """
    ready = compiled(rules)
    wanted = ready.select(F.explode("tokens").alias("token")).distinct()
    seen = urls.select(F.explode(_tokens(F.col("_address"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    counts = wanted.join(seen, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))
    each = ready.select("rule", "site", "verdict", F.explode("tokens").alias("token"))
    rarest = each.join(counts, "token").groupBy("rule", "site", "verdict").agg(F.min(F.struct("n", "token")).alias("_m"))
    found = ready.join(rarest, ["rule", "site", "verdict"], "left")
    return found.select("rule", "site", "verdict", "regex", "rank", F.coalesce("_m.token", F.lit("")).alias("token"))


def _best(fits: Column) -> Column:
    return F.array_max(F.transform(fits, lambda e: F.struct(e["rank"].alias("rank"), e["verdict"].alias("verdict"), e["rule"].alias("rule"), e["site"].alias("site"))))


def _fits(entry: Column) -> Column:
    return F.regexp_like(F.when(entry["site"], F.col("_site")).otherwise(F.col("_address")), entry["regex"])


def _in_row(urls: DataFrame, index: DataFrame, n_rules: int) -> DataFrame:
    """Look the rules up in a hash table of token buckets that every task holds as a constant; no URL moves."""
    buckets = 1
    while buckets < 2 * n_rules:
        buckets *= 2
    bucket = lambda token: F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")
    table: list[list[dict]] = [[] for _ in range(buckets)]
    for row in index.withColumn("_b", bucket(F.col("token"))).collect():  # at most ``index_bytes``
        entry = row.asDict()
        table[entry.pop("_b")].append(entry)
    kind = "array<array<struct<token:string,rule:string,site:boolean,verdict:string,regex:string,rank:int>>>"
    held = F.from_json(F.lit(json.dumps(table)), kind)
    fetched = F.flatten(F.transform(_tokens(F.col("_address")), lambda t: F.filter(F.get(held, bucket(t)), lambda e: e["token"] == t)))
    return urls.withColumn("_best", _best(F.filter(fetched, _fits)))


def _by_join(urls: DataFrame, index: DataFrame) -> DataFrame:
    """The same for rule lists of any size: distinct addresses meet the rules by token, hot tokens salted."""
    distinct = stored(urls.select("_site", "_address").distinct())
    asked = stored(distinct.select("_site", "_address", F.explode(_tokens(F.col("_address"))).alias("token")))
    met = salted_join(asked, index, ["token"], ["_address"])
    fits = met.where(F.regexp_like(F.when(F.col("site"), F.col("_site")).otherwise(F.col("_address")), F.col("regex")))
    best = fits.groupBy("_site", "_address").agg(F.max(F.struct("rank", "verdict", "rule", "site")).alias("_best"))
    return salted_join(urls, best, ["_site", "_address"], ["page_id"], "left")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of every page.

    The longest site rule that fits decides; ``rule`` is its text. Where none fits, ``rule`` is null and pattern
    rules decide (``pattern`` is the deciding one): an allowing one before all blocking ones, else ``default``.
    Of rules of one length a blocking one wins. A null URL or one without ``://`` has an empty host and path
    and can only be met by patterns that fit empty text. Repeated pages and null page ids are rows like any other;
    other columns of ``pages`` are not read.
    """
    host, path, rest = address(F.col("_url"))
    split = pages.select("page_id", F.col("url").alias("_url")).select("page_id", host.alias("host"), path.alias("path"), F.concat(host, rest).alias("_address"))
    urls = split.withColumn("_site", F.concat("host", "path"))
    index = stored(rule_index(urls, rules))
    size = index.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("regex") + F.octet_length("rule")), F.lit(0)).alias("bytes")).first()
    if size["bytes"] + 64 * size["n"] <= index_bytes:
        judged = _in_row(urls, index, size["n"])
    else:
        judged = _by_join(stored(urls), index)
    best, site = F.col("_best"), F.coalesce(F.col("_best.site"), F.lit(False))
    return judged.select(
        "page_id", "host", "path", F.when(site, best["rule"]).alias("rule"),
        F.coalesce(best["verdict"], F.lit(default)).alias("verdict"), F.when(~site, best["rule"]).alias("pattern"),
    )
