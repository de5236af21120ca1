"""License scans by ordered signature rules, in DataFrame functions only.

Every rule has a keyword, a pattern and a priority. Texts without any word of
a short list take no part; in the others only the rules whose keyword occurs
are matched. A detection that lies inside another one of at least its own
priority is suppressed. Detections are found, sorted and resolved inside the
row, in time that grows with the text, so nothing is exploded or shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.license_rules import GATE, RULES, TAG, Rule, over_words

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_OPEN, _CLOSE = "\x01", "\x02"
#: Confidence of the best detection, by priority.
SCORES = [0.0, 0.5, 0.8, 1.0]
_HIT = "struct<start:int,back:int,low:int,rule:int,priority:int,label:string,base:boolean>"


def normalised(text: Column) -> Column:
    """The lower-cased words, each with a blank on either side; without words the empty string."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    words = F.trim(F.regexp_replace(lower, _BETWEEN, "  "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _table(rules: list[Rule]) -> Column:
    return F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.keyword.replace(" ", "  ")).alias("keyword"),
                 F.lit(over_words(r.pattern)).alias("pattern"), F.lit(r.priority).alias("priority"),
                 F.lit(r.base).alias("base")) for n, r in enumerate(rules)])


def _at(tokens: Column, mark: str, shift: int) -> Column:
    """Words before each mark; the marks of earlier detections count as tokens too."""
    places = F.filter(F.transform(tokens, lambda t, i: F.when(t == mark, i)), lambda i: i.isNotNull())
    return F.transform(places, lambda i, k: (i - 2 * k - shift).cast("int"))


def _hits(words: Column, rule: Column) -> Column:
    """Detections of one rule: first word, word after the last (below zero, for sorting), and the rule."""
    marked = F.regexp_replace(words, rule["pattern"], F.lit(f" {_OPEN}$0{_CLOSE} "))
    tokens = F.split(F.trim(marked), F.lit(" +"))
    return F.zip_with(
        _at(tokens, _OPEN, 0), _at(tokens, _CLOSE, 1),
        lambda start, end: F.struct(
            start.alias("start"), (-end).alias("back"), (-rule["priority"]).alias("low"), rule["rule"].alias("rule"),
            rule["priority"].alias("priority"), rule["label"].alias("label"), rule["base"].alias("base")))


def _resolved(hits: Column) -> Column:
    """Labels and best priority of the detections that are not suppressed.

    In this order a detection can only lie inside an earlier one, so the
    furthest end so far, for each priority, decides.
    """
    levels = range(1, TAG + 1)
    state = F.struct(*[F.lit(0).alias(f"far{p}") for p in levels], F.lit(0).alias("best"),
                     F.array().cast("array<string>").alias("labels"))

    def step(s: Column, h: Column) -> Column:
        end = -h["back"]
        far = reduce(lambda rest, p: F.when(h["priority"] == p, s[f"far{p}"]).otherwise(rest), levels, F.lit(0))
        stays = far < end
        return F.struct(
            *[F.when((h["priority"] >= p) & (end > s[f"far{p}"]), end).otherwise(s[f"far{p}"]).alias(f"far{p}")
              for p in levels],
            F.when(stays, F.greatest(s["best"], h["priority"])).otherwise(s["best"]).alias("best"),
            F.when(stays, F.array_union(s["labels"], F.array(h["label"]))).otherwise(s["labels"]).alias("labels"))

    return F.aggregate(hits, state, step)


def scan_licenses(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``.

    Base detections count all their places and are never suppressed. ``score`` is the
    confidence of the best detection, 0 without any. A null or empty text has
    no words and no detections: empty labels, null words, score 0. Rows are
    independent: repeated rows and null ids pass through; an empty table gives
    an empty result.
    """
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), normalised(F.col("text")).alias("words"))
    gate = reduce(lambda a, b: a | b, [F.contains("words", F.lit(g)) for g in GATE])
    words = F.col("words")
    found = F.flatten(F.transform(
        F.filter(_table(rules), lambda r: F.contains(words, r["keyword"])), lambda r: _hits(words, r)))
    nothing = F.array().cast(f"array<{_HIT}>")
    out = out.select(
        "doc_id",
        ((F.octet_length("words") - F.octet_length(F.replace("words", F.lit(" "), F.lit("")))) / 2).cast("bigint").alias("n_words"),
        F.when(gate, F.array_sort(found)).otherwise(nothing).alias("hits"))
    out = out.select("doc_id", "n_words", "hits", F.filter("hits", lambda h: h["base"]).alias("base"),
                     _resolved(F.col("hits")).alias("kept"))
    labels = F.array_distinct(F.transform("base", lambda h: h["label"]))
    scores = F.array(*map(F.lit, SCORES))
    return out.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda h: h["start"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("base", lambda h: h["start"])).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.col("kept.labels"))), ",").alias("labels"),
        F.element_at(scores, F.col("kept.best") + 1).alias("score"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The same for a database with RE2 patterns.
SQL = f"""
WITH rules(rule, label, keyword, pattern, priority, base) AS (VALUES {", ".join(
    f"({n}, {_quoted(r.label)}, {_quoted(r.keyword.replace(' ', '  '))}, {_quoted(over_words(r.pattern))}, "
    f"{r.priority}, {str(r.base).lower()})" for n, r in enumerate(RULES))}),
lower AS (
  SELECT row_number() OVER () AS n, doc_id,
         trim(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_BETWEEN}', '  ', 'g')) AS w
  FROM documents),
texts AS (SELECT n, doc_id, CASE WHEN w = '' THEN '' ELSE ' ' || w || ' ' END AS words FROM lower),
marked AS (
  SELECT n, rule, label, priority, base,
         string_split_regex(trim(regexp_replace(words, pattern, ' ' || chr(1) || '\\0' || chr(2) || ' ', 'g')), ' +') AS tokens
  FROM texts JOIN rules ON contains(words, keyword)),
tokens AS (
  SELECT n, rule, label, priority, base, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS i FROM marked),
places AS (
  SELECT *, row_number() OVER (PARTITION BY n, rule, token ORDER BY i) - 1 AS k
  FROM tokens WHERE token IN (chr(1), chr(2))),
hits AS (
  SELECT n, rule, label, priority, base, k, min(i) - 2 * k AS start, max(i) - 2 * k - 1 AS stop
  FROM places GROUP BY n, rule, label, priority, base, k),
kept AS (
  SELECT * FROM hits h WHERE NOT EXISTS (
    SELECT 1 FROM hits g WHERE g.n = h.n AND g.start <= h.start AND g.stop >= h.stop AND g.priority >= h.priority
      AND (g.start < h.start OR g.stop > h.stop OR g.priority > h.priority OR g.rule < h.rule))),
base AS (
  SELECT n, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
         list_sort(list(DISTINCT label)) AS labels FROM hits WHERE base GROUP BY n),
every AS (
  SELECT n, list_sort(list(DISTINCT label)) AS labels, max(priority) AS best
  FROM (SELECT n, label, priority FROM kept UNION ALL SELECT n, label, 0 FROM hits WHERE base) GROUP BY n)
SELECT doc_id, CAST((length(words) - length(replace(words, ' ', ''))) / 2 AS BIGINT) AS n_words,
       coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       coalesce(array_to_string(every.labels, ','), '') AS labels,
       CAST([{", ".join(map(str, SCORES))}][coalesce(best, 0) + 1] AS DOUBLE) AS score
FROM texts LEFT JOIN base USING (n) LEFT JOIN every USING (n)
"""
