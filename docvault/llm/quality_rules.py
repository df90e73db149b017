"""Quality rules as a bitmask ledger (DataFrame functions only, one narrow map over the texts).

Every rule is evaluated once per document.  The *ledger* keeps the measurements the rules look at and one
64-bit integer ``failed``, bit *b* set when rule *b* fails.  A *policy* is a versioned set of rules: applying
it is ``failed & mask = 0``, and an ablation (what each rule of a policy costs) is an aggregation over the
at most ``2 ** len(RULES)`` distinct masks; neither reads a text again.

Defined results: a null, empty or blank text has no words and fails ``few_words``; ties and repeated rows are
judged row by row; extra columns are not touched (``ledger`` returns the key columns asked for); an empty
table gives an empty ledger.  Windows are compared by a 64-bit hash of their words within one document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.common import SEPARATORS, SEPARATOR_RUN, table, word_array

WINDOW = 5  # words of the windows that count as repeated
SYMBOLS = "[^#*$%&|<>]+"  # what is not a symbol


@dataclass(frozen=True)
class Rule:
    """One rule: ``fails`` is a condition over the measurement columns; ``bit`` never changes once given."""

    bit: int
    name: str
    fails: str


RULES = [
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "n_symbols > n_words"),
    Rule(3, "duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "long_words", "word_chars > 40 * n_words"),
]

# Policies by version: the names of the rules that reject a document.
POLICIES = {
    "base": ["few_words", "repeated_words"],
    "v1": ["few_words", "repeated_words", "symbols", "duplicate_lines", "long_words"],
}


def mask_of(names: list[str], rules: list[Rule] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in dict.fromkeys(names))


def measure(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Key columns and the measurements of each document (all long)."""
    safe = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*[F.col(k) for k in keys], safe.alias("_text"), word_array(text).alias("_words"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SEPARATORS)) != "")
    base = base.select(
        *keys, "_words", F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("_text", SEPARATOR_RUN, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        lines.alias("_lines"))
    base = base.select(
        *keys, "n_words", "word_chars", "n_symbols", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    windows = F.transform(
        F.slice("_hashes", F.lit(1), F.greatest(F.size("_hashes") - F.lit(WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(F.col("_hashes"), i + k) for k in range(1, WINDOW)]))
    kept = [*keys, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    base = base.select(*kept, windows.alias("_windows"))
    # most documents repeat no window: only the others are sorted
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.select(*kept, F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), pairs).alias("_pairs"))
    twice = F.filter("_pairs", lambda x, j: F.coalesce(x["h"] == F.get(F.col("_pairs"), j - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get(F.col("_pairs"), j + 1)["h"], F.lit(False)))
    base = base.select(*kept, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_at"))
    steps = F.transform("_at", lambda p, j: F.least(F.lit(WINDOW), F.get(F.col("_at"), j + 1) - p))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    # the row id, always >= 0, is not deterministic: it keeps Spark from copying the steps above into a filter below
    total = F.when(F.monotonically_increasing_id() >= 0, F.coalesce(total, F.lit(0)).cast("long"))
    return base.select(*kept, total.alias("n_repeat_words"))


def ledger(docs: DataFrame, keys: list[str], text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """Key columns, measurements and ``failed``: the bits of the rules that the document fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(docs, keys, text).withColumn("failed", failed)


def apply_policy(led: DataFrame, policy: str = "v1", policies: dict[str, list[str]] = POLICIES) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy fails."""
    return led.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask_of(policies[policy]))) == 0)


def ablation(led: DataFrame, policy: str = "v1", policies: dict[str, list[str]] = POLICIES) -> DataFrame:
    """One row per rule of the policy: documents failing it, documents only it rejects, and what the policy
    would keep without it.  One aggregation over the distinct masks (bounded by the number of rules)."""
    mask = mask_of(policies[policy])
    by_mask = (led.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("m")).agg(F.count("*").alias("n")))
    bits = {r.name: 1 << r.bit for r in RULES}
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(bits[n]).cast("long").alias("bit"))
                      for n in policies[policy]])
    rows = by_mask.select("m", "n", F.explode(rules).alias("r")).select("m", "n", "r.rule", "r.bit")
    hit = F.col("m").bitwiseAND(F.col("bit")) != 0
    return rows.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when((F.col("m") == 0) | (F.col("m") == F.col("bit")), F.col("n")).otherwise(0)).alias("kept_without"))


def select_kept(docs: DataFrame, text: str = "text", policy: str = "v1") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, columns unchanged (one map, no join back)."""
    cols = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row")
    led = apply_policy(ledger(docs.select(whole, F.col(f"`{text}`").alias("_source")), ["_row"], "_source"), policy)
    return led.where("kept").select("_row.*")


def query(spark, sf_dir):
    """op1: the ledger of all documents under policy ``v1``."""
    led = apply_policy(ledger(table(spark, sf_dir, "documents"), ["doc_id"]), "v1")
    base = F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES["base"]))) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), "kept", "failed", "n_lines")


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
pos AS (SELECT rid, unnest(range(1, len(ws) - 3)) AS p, ws FROM w WHERE len(ws) >= 5),
win AS (SELECT rid, p, array_to_string(ws[p:p + 4], ' ') AS g FROM pos),
twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (
  SELECT rid, sum(least(5, coalesce(nxt - p, 5))) AS n_repeat_words
  FROM (SELECT rid, p, lead(p) OVER (PARTITION BY rid ORDER BY p) AS nxt FROM twice) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines
  FROM w LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
f AS (
  SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
         + (CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END)
         + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
         + (CASE WHEN word_chars > 40 * n_words THEN 16 ELSE 0 END) AS BIGINT) AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed, n_lines
FROM f
"""
