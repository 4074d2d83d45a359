"""Quality rules: a threshold table compiled into one projection of Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainpanel.llm.common import BLANKS

SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from he in is it of on or that the this to was were with "
    "auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au avec ce dans de des du elle en est et il la le les par pas pour que qui sur un une "
    "al con del el es la las los más no por que se su una y").split()


@dataclass(frozen=True)
class Threshold:
    """A text passes where ``low <= metric <= high``; None leaves that side open."""

    metric: str
    low: float | None = None
    high: float | None = None


#: Ratios to the words of the text, but for ``dup_line_ratio`` (to the lines with a word).
THRESHOLDS = (
    Threshold("mean_word_chars", 3.0, 10.0),
    Threshold("symbol_ratio", None, 0.1),
    Threshold("stop_word_ratio", 0.05, None),
    Threshold("dup_line_ratio", None, 0.5),
)
MIN_WORDS = 50
REPEAT_PERCENT = 50
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII blanks."""
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words covered by three-word windows that occur twice or more, from the windows' hashes.

    Equal hashes become neighbours by sorting (hash, position); a covered stretch then counts three
    words, less what the next one shares with it.
    """
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
        marked = F.transform(s, lambda x, k: F.when(
            F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)), x["i"]))
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def covered(at: Column) -> Column:
        widths = F.transform(at, lambda i, k: F.least(F.coalesce(F.get(at, k + 1) - i, F.lit(3)), F.lit(3)))
        return F.aggregate(widths, F.lit(0).cast("long"), lambda a, w: a + w)

    bound = F.element_at(F.transform(F.array(ordered), lambda s: F.element_at(
        F.transform(F.array(starts(s)), covered), 1)), 1)
    none_twice = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(none_twice, F.lit(0).cast("long")).otherwise(bound)


def counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` and the counts that the ratios use, as the struct ``__q``."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    split = documents.withColumn("__text", whole).withColumn("__words", words_of(F.col("__text")))
    words = F.col("__words")
    n = F.size(words)
    windows = F.transform(
        F.slice(words, 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    lines = F.filter(F.split("__text", "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    stop = F.filter(F.split(F.lower("__text"), "[ \\t-\\r.,;:!?]+"), lambda w: w.isin(*STOP_WORDS))
    hashed = split.withColumn("__windows", windows).withColumn("__lines", lines)
    # A generator of one row: filters on the counts stay above it and don't work them out anew.
    return hashed.withColumn("__q", F.explode(F.array(F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate("__text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(words, F.col("__windows")).alias("n_repeat_words"),
        F.size(stop).cast("long").alias("n_stop_words"),
    )))).drop("__text", "__words", "__windows", "__lines")


def _metrics(q: Column) -> dict[str, Column]:
    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return {
        "mean_word_chars": ratio(q["word_chars"], q["n_words"]), "symbol_ratio": ratio(q["n_symbols"], q["n_words"]),
        "stop_word_ratio": ratio(q["n_stop_words"], q["n_words"]),
        "dup_line_ratio": ratio(q["n_dup_lines"], q["n_lines"]),
    }


def base_fails(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > REPEAT_PERCENT * q["n_words"])


def passes(q: Column, thresholds: Sequence[Threshold] = THRESHOLDS) -> Column:
    """All thresholds as one Boolean expression."""
    metrics, verdict = _metrics(q), F.lit(True)
    for t in thresholds:
        if t.low is not None:
            verdict &= metrics[t.metric] >= t.low
        if t.high is not None:
            verdict &= metrics[t.metric] <= t.high
    return verdict


def judge_quality(
    documents: DataFrame, text: str = "text", thresholds: Sequence[Threshold] = THRESHOLDS
) -> DataFrame:
    """``documents`` and a struct ``__q`` of counts, ratios, ``base_failed`` and ``kept``; no exchange.

    A NULL or blank text has no words, ratios of 0, and fails. Repeated rows are judged alike; an
    empty table gives an empty result; texts are read whole. Columns of ``documents`` are kept.
    """
    counted = counts(documents, text)
    q = F.col("__q")
    return counted.withColumn("__q", F.struct(
        *(q[c].alias(c) for c in _COUNTS), *(m.alias(k) for k, m in _metrics(q).items()),
        base_fails(q).alias("base_failed"), (~base_fails(q) & passes(q, thresholds)).alias("kept")))


def keep_good(documents: DataFrame, text: str = "text", thresholds: Sequence[Threshold] = THRESHOLDS) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge_quality(documents, text, thresholds).filter("__q.kept").drop("__q")


def quality_query(documents: DataFrame) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge_quality(documents.select("doc_id", "text")).select("doc_id", *(f"__q.{c}" for c in names))


def quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
    WITH base AS (
      SELECT doc_id, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\f\r]+'), lambda w: w <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\f\r]')) AS lines
      FROM documents),
    numbered AS (SELECT *, row_number() OVER () AS r FROM base),
    windows AS (
      SELECT r, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS g
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM numbered)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
    covered AS (
      SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
    q AS (
      SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[ \t\n\x0b\f\r]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(regexp_split_to_array(lower(text), '[ \t\n\x0b\f\r.,;:!?]+'),
          lambda w: w IN ({stop}))) AS n_stop_words
      FROM numbered LEFT JOIN covered c USING (r)),
    judged AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM q)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND word_chars >= 3 * n_words AND word_chars <= 10 * n_words
        AND n_symbols * 10 <= n_words AND n_stop_words * 20 >= n_words AND n_dup_lines * 2 <= n_lines AS kept
    FROM judged"""
