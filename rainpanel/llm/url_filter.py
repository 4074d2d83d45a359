"""URL verdicts: ordered host and path rules, then a weighted vocabulary matched by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainpanel.llm.common import ascii_lower


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


# The rules that the query is asked to apply.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: One of these rejects a URL.
STRICT_TERMS = ("casino", "escort", "hentai", "porn", "porno", "viagra", "xxx")
#: So many different ones of these reject it.
SOFT_TERMS = ("adult", "bet", "bonus", "cheap", "farm", "free", "loan", "pills", "replica", "spam", "win")
SOFT_HITS = 2

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest fitting rule as a struct of its text and verdict, or NULL."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host) + len(r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        own = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(fits, own).otherwise(chosen)
    return chosen


def _bounded(text: str, start: int, end: int) -> bool:
    """Whether the neighbours of a match are neither ASCII letters nor digits."""
    before, after = text[start - 1:start] if start else "", text[end:end + 1]
    return not (before.isascii() and before.isalnum() or after.isascii() and after.isalnum())


def vocabulary_rejects(
    strict: Sequence[str] = STRICT_TERMS, soft: Sequence[str] = SOFT_TERMS, soft_hits: int = SOFT_HITS
):
    """A column function on lower-case URLs: true with one strict term or ``soft_hits`` different soft ones.

    A term counts where no ASCII letter or digit touches it. NULL and empty URLs are not rejected.
    """
    terms = {**{t: False for t in soft}, **{t: True for t in strict}}

    @F.pandas_udf("boolean")
    def rejects(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for term, is_strict in terms.items():
            automaton.add_word(term, (term, is_strict))
        automaton.make_automaton()

        def one(url: str | None) -> bool:
            seen = set()
            for last, (term, is_strict) in automaton.iter(url or ""):
                if term not in seen and _bounded(url, last - len(term) + 1, last + 1):
                    if is_strict:
                        return True
                    seen.add(term)
            return len(seen) >= soft_hits

        for urls in batches:
            yield urls.map(one, na_action=None).astype(bool)

    return rejects


def judge_urls(
    pages: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS, soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block), row by row.

    A fitting rule decides; without one, the vocabulary does. A NULL url, or one without ``://``,
    has an empty host and path, so no rule; its text is still held against the vocabulary. Repeated
    rows stay. Columns of those four names are replaced, others are kept.
    """
    link = F.col(f"`{url}`")
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rejects = vocabulary_rejects(strict, soft, soft_hits)
    judged = pages.select(
        *kept, host_of(link).alias("host"), path_of(link).alias("path"), rejects(ascii_lower(link)).alias("__rejects"))
    return (
        judged.withColumn("__rule", longest_rule(F.col("host"), F.col("path"), rules))
        .withColumn("rule", F.col("__rule.rule"))
        .withColumn("verdict", F.coalesce(
            F.col("__rule.verdict"), F.when(F.col("__rejects"), "block").otherwise("allow")))
        .drop("__rule", "__rejects")
    )


def urls_query(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def urls_sql() -> str:
    """The same verdicts in DuckDB's SQL, with regular expressions in place of the automaton."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def hit(term: str) -> str:
        return f"regexp_matches(low, '(?s)(^|[^a-z0-9]){term}([^a-z0-9]|$)')"

    def cases(of) -> str:
        return " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{of(r)}'"
            for r in sorted(RULES, key=lambda r: -len(r.host) - len(r.path)))

    return f"""
    WITH parts AS (
      SELECT page_id, coalesce(translate(url, '{upper}', '{lower}'), '') AS low,
        translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{upper}', '{lower}') AS host,
        coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path
      FROM pages)
    SELECT page_id, host, path, CASE {cases(lambda r: r.host + r.path)} END AS rule,
      CASE {cases(lambda r: r.verdict)}
        WHEN {' OR '.join(map(hit, STRICT_TERMS))}
          OR {' + '.join(f'CAST({hit(t)} AS INT)' for t in SOFT_TERMS)} >= {SOFT_HITS} THEN 'block'
        ELSE 'allow' END AS verdict
    FROM parts"""
