"""Operator 4, URL filters: rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens (runs of a-z and 0-9) that every matching URL has as whole
tokens. The rarest of them in the URLs at hand is the rule's index key. A URL's tokens fetch candidate rules by a join,
and only candidates run their expression. Rules without a whole token have the key '', which every URL carries.

Three rule forms:
* ``SiteRule(action, host, path)`` fits the host and all subdomains if the path starts with ``path``;
* ``PatternRule(action, pattern)`` on host + path, any case: ``||`` begins at the host or one of its parent domains,
  ``|`` is the begin or end, ``*`` is any run, ``^`` is a separator or the end;
* ``HostWordRule(action, word)`` fits a host that has ``word`` between two of ``.``, ``-`` and its ends.

Of the site rules that fit, the longest wins; without one, allowing patterns beat blocking ones; else ``allow``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import columns
from duotower.llm.url_words import ALLOWED, HOST_WORDS, PATH_WORDS

_TOKEN = "[a-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SiteRule:
    action: str
    host: str
    path: str

    name = property(lambda self: self.host + self.path)
    rank = 2

    def regex(self) -> str:
        return r"^(?:[^/]*\.)?" + _literal(self.host + self.path)

    def tokens(self) -> list[str]:
        # the last token of the path may go on in the URL
        whole = (self.host + self.path).lower()
        return [m[0] for m in re.finditer(_TOKEN, whole) if m.end() < len(whole)]


@dataclass(frozen=True)
class PatternRule:
    action: str
    pattern: str

    name = property(lambda self: self.pattern)
    rank = property(lambda self: 1 if self.action == "allow" else 0)

    def _parts(self) -> tuple[str, str, str]:
        body = self.pattern
        head = "||" if body.startswith("||") else "|" if body.startswith("|") else ""
        body = body[len(head):]
        tail = "|" if body.endswith("|") else ""
        return head, body[:len(body) - len(tail)].lower(), tail

    def regex(self) -> str:
        head, body, tail = self._parts()
        middle = "".join(".*" if c == "*" else r"(?:[^a-z0-9_.%-]|$)" if c == "^" else _literal(c) for c in body)
        return "(?is)" + {"||": r"^(?:[^/]*\.)?", "|": "^", "": ""}[head] + middle + ("$" if tail else "")

    def tokens(self) -> list[str]:
        head, body, tail = self._parts()
        out = []
        for m in re.finditer(_TOKEN, body):
            left = body[m.start() - 1] != "*" if m.start() else bool(head)
            right = body[m.end()] != "*" if m.end() < len(body) else bool(tail)
            if left and right:
                out.append(m[0])
        return out


@dataclass(frozen=True)
class HostWordRule:
    action: str
    word: str

    name = property(lambda self: f"host:{self.word}")
    rank = property(lambda self: 1 if self.action == "allow" else 0)

    def regex(self) -> str:
        return r"(?is)^(?:[^/]*[.-])?" + _literal(self.word) + "(?:[./-]|$)"

    def tokens(self) -> list[str]:
        return re.findall(_TOKEN, self.word.lower())


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):X}}}" for c in text)


# The rules of the registered query: fixed values of its contract, and a general block list.
SITE_RULES = (SiteRule("allow", "org", "/"), SiteRule("block", "example.org", "/es/"), SiteRule("block", "example.org", "/en/1"),
              SiteRule("allow", "com", "/fr/"), SiteRule("block", "com", "/de/"))
PATTERN_RULES = (*[HostWordRule("block", w) for words in HOST_WORDS.values() for w in dict.fromkeys(words.split())],
                 *[PatternRule("block", f"/{w}^") for w in PATH_WORDS], *[HostWordRule("allow", w) for w in ALLOWED])


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def judge_urls(pages: DataFrame, rules=(*SITE_RULES, *PATTERN_RULES), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: the id column, host, path, rule (the site rule that decides, else null), verdict, pattern.

    Defined results: a null url, or one without ``://``, has empty host and path and is allowed unless a pattern fits
    the empty string; repeated rows are judged each; an empty table gives no rows; other columns are ignored.
    ``rules`` is a driver-side list, so its size bounds what is broadcast.
    """
    pages = columns(pages, page_id=id_col, url=url_col)
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    whole = F.concat("host", "path")
    tokens = F.array_distinct(F.concat(F.regexp_extract_all(F.lower(whole), F.lit(f"({_TOKEN})")), F.array(F.lit(""))))

    wanted = sorted({t for r in rules for t in r.tokens()})
    counts = {}
    if wanted:      # as many rows as the rules have tokens
        seen = urls.select(F.explode(tokens).alias("token")).where(F.col("token").isin(wanted)).groupBy("token").count()
        counts = {r["token"]: r["count"] for r in seen.collect()}
    index = [(min(r.tokens(), key=lambda t: (counts.get(t, 0), t), default=""), r.regex(), r.rank, len(r.name), r.name, r.action) for r in rules]
    spark = pages.sparkSession
    table = F.broadcast(spark.createDataFrame(index, "token string, regex string, rank int, size int, name string, action string"))

    rows = urls.withColumn("uid", F.monotonically_increasing_id()).withColumn("token", F.explode(tokens))
    fits = F.regexp_like(whole, F.col("regex"))
    best = F.max(F.when(fits, F.struct("rank", "size", "name", "action")))
    # tokens of one page stand together, so the partial aggregate leaves one row per page before the shuffle
    judged = rows.join(table, "token", "left").groupBy("uid", "page_id", "host", "path").agg(best.alias("best"))
    site = F.col("best.rank") == 2
    return judged.select("page_id", "host", "path", F.when(site, F.col("best.name")).alias("rule"),
                         F.coalesce("best.action", F.lit("allow")).alias("verdict"), F.when(~site, F.col("best.name")).alias("pattern"))


def rules_sql(rules=(*SITE_RULES, *PATTERN_RULES)) -> str:
    """DuckDB SQL for ``judge_urls`` over ``pages``: every rule is tried on every URL."""
    def quoted(s):
        return "'" + s.replace("'", "''") + "'"

    rows = ", ".join(f"({quoted(r.regex())}, {r.rank}, {len(r.name)}, {quoted(r.name)}, {quoted(r.action)})" for r in rules)
    return f"""WITH rules(regex, rank, size, name, action) AS (VALUES {rows}),
u AS (SELECT page_id, row_number() OVER () AS uid, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, uid, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT h.uid, arg_max({{'rank': r.rank, 'name': r.name, 'action': r.action}}, r.rank * 1000000 + r.size) AS best
      FROM h JOIN rules r ON regexp_matches(h.host || h.path, r.regex) GROUP BY h.uid)
SELECT page_id, host, path, CASE WHEN best.rank = 2 THEN best.name END AS rule, coalesce(best.action, 'allow') AS verdict,
       CASE WHEN best.rank < 2 THEN best.name END AS pattern
FROM h LEFT JOIN m ON h.uid = m.uid"""
