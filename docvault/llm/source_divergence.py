"""Source divergence audit: how far the term frequencies of every source lie from those of the others in its language.

Each document becomes an exact sparse vector of term counts, and the vectors are summed by (lang, source), entry by entry,
with partial sums before the shuffle, so no dense vector is ever held.  For texts of up to ``TEXT_BYTES`` in all (which
bounds the vocabulary) the vectors come from ``CountVectorizer`` with the minimum of documents and the greatest vocabulary
size, one vocabulary per language by a tag on every term.  It holds its vocabulary on the driver and in every task, and a
vocabulary grows with the texts, so beyond that bound the same entries are made by grouping: a small helper cuts and counts
the terms of a batch of documents, at most ``HELD_TERMS`` entries at a time, and one aggregate sums their occurrences and
documents.

The sums are kept as one row a term with the counts of its sources.  A pair of sources is compared over all kept terms,
but only entries are visited: of ``sum f(p(t), q(t))`` the terms in neither source have one value, the terms in one source
depend on their count there alone, so they are taken from the histogram of counts of each source, and the terms in both
correct what the two histograms said.

Probabilities are whole billionths, products are decimals, and sums are kept in two parts of 64 bits or as decimals, so
results are exact at any count.

Defined results: null text, lang and source count as the empty text; documents without terms make their group occur;
a language without kept terms has pairs of value 0 and no terms; repeated rows count as documents of their own; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvault.llm.common import stage_table, table
from docvault.session import broadcast_if_small

MIN_DOCS = 3
RANKS = 200
SCALE = 1_000_000_000
TEXT_BYTES = 64 << 20
MAX_INT = 2**31 - 1
BETWEEN_TERMS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
TAG = "\0"  # between language and term; no term holds it
ALWAYS = TAG + TAG  # an entry that every fitted vocabulary has; no tagged term is equal to it
GROUP = ["lang", "source"]
HELD_TERMS = 300_000  # entries that a task counts before it hands them on
COUNTED = "lang string, source string, term binary, n long, docs long"
# Bytes of UTF-8: A-Z lower-cased, a space for what separates terms; bytes of characters beyond ASCII stay.
TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b) in string.ascii_letters else b if b > 0x7F else 0x20 for b in range(256))


def terms(docs: DataFrame) -> DataFrame:
    """``lang``, ``source`` and the array of terms (runs of letters and characters beyond ASCII, A-Z lower-cased)."""
    lower = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                       F.array_remove(F.split(lower, BETWEEN_TERMS), "").alias("terms"))


def document_vectors(rows: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """``(lang, source, vector)`` of every document and the vocabulary ``(entry, lang, term)`` of the vectors."""
    spark = rows.sparkSession
    tagged = rows.select(*GROUP, F.transform("terms", lambda t: F.concat("lang", F.lit(TAG), t)).alias("tagged"))
    known = spark.range(min_docs).select(F.array(F.lit(ALWAYS)).alias("tagged"))
    model = CountVectorizer(inputCol="tagged", outputCol="vector", minDF=float(min_docs), vocabSize=MAX_INT).fit(
        tagged.select("tagged").unionByName(known))
    words = [(i, *w.rsplit(TAG, 1)) for i, w in enumerate(model.vocabulary) if w != ALWAYS]
    vocabulary = stage_table(spark.createDataFrame(words, "entry int, lang string, term string"), "vocabulary")
    return model.transform(tagged).select(*GROUP, "vector"), vocabulary


def _sums_of_vectors(rows: DataFrame, min_docs: int) -> DataFrame:
    vectors, vocabulary = document_vectors(rows, min_docs)
    v = vectors.select(*GROUP, F.unwrap_udt("vector").alias("v"))
    entries = v.select(*GROUP, F.inline(F.arrays_zip(F.col("v.indices").alias("entry"), F.col("v.values").alias("n"))))
    sums = entries.groupBy(*GROUP, "entry").agg(F.sum(F.col("n").cast("long")).alias("n"))
    return sums.join(broadcast_if_small(vocabulary.select("entry", "term")), "entry").select(*GROUP, "term", "n")


def _count_terms(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed_on():
        for (lang, source), (n, docs) in held.items():
            columns = [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)), pa.array(list(n), pa.binary()),
                       pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for b in batches:
        for lang, source, text in zip(*(b.column(c) for c in range(3))):
            n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            found = text.as_py().translate(TERM_BYTES).split()
            size -= len(n)
            n.update(found)
            docs.update(set(found))
            size += len(n)
            if size >= most:
                yield from handed_on()
                size = 0
    yield from handed_on()


def _sums_by_grouping(docs: DataFrame, most: int = HELD_TERMS) -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` of every term of every group."""
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in GROUP], F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counted = texts.mapInArrow(lambda batches: _count_terms(batches, most), COUNTED)
    sums = counted.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return sums.withColumn("term", F.col("term").cast("string"))


def postings(docs: DataFrame, min_docs: int = MIN_DOCS, text_limit: int = TEXT_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(terms, groups)``, both written: the kept terms ``(lang, term, lang_n, counts)`` with the occurrences in each group
    that has any, ``counts`` an array of ``(gid, n)``; and every ``(gid, lang, source)``."""
    rows = terms(docs)
    groups = stage_table(rows.select(*GROUP).distinct().withColumn("gid", F.monotonically_increasing_id()), "source-groups")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sums = _sums_of_vectors(rows, min_docs).withColumn("docs", F.lit(min_docs)) if size <= text_limit else _sums_by_grouping(docs)
    sums = sums.join(broadcast_if_small(groups), GROUP)
    kept = sums.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"),
                                            F.collect_list(F.struct("gid", "n")).alias("counts"))
    return stage_table(kept.where(F.col("docs") >= min_docs).drop("docs"), "term-counts"), groups


def _share(n: Column | str, total: str = "total", kept: str = "kept") -> Column:
    """Probability of a term with ``n`` occurrences, in whole billionths, at least one."""
    n = (F.col(n) if isinstance(n, str) else n).cast("decimal(20,0)")
    whole = F.nullif(F.col(total) + F.col(kept), F.lit(0)).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", (n + 1) * F.lit(SCALE).cast("decimal(10,0)"), whole)


def _gap(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def _exact_sum(value: Column, keys: list[str], rows: DataFrame) -> DataFrame:
    """Sums of 64-bit values, in two parts so that they cannot overflow."""
    high = F.call_function("div", value, F.lit(SCALE))
    both = rows.select(*keys, value.alias("_v"), high.alias("_h")).groupBy(*keys).agg(
        F.sum("_h").alias("_h"), F.sum(F.col("_v") - F.col("_h") * SCALE).alias("_l"))
    return both.select(*keys, (F.col("_h").cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)") + F.col("_l")).cast("decimal(38,0)").alias("value"))


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``(gid, other, value)`` for every ordered pair of sources of a language.

    ``counts`` ``(lang, term, shares)``: an array of ``(gid, p, p0)``, the group's probability of the term and that of a
    term it lacks; ``groups`` ``(gid, lang, kept, used, p0)``."""
    h = broadcast_if_small(groups.select("lang", F.col("gid").alias("other"), F.col("used").alias("other_used"), F.col("p0").alias("q0")))
    keys, distinct = ["gid", "other"], F.col("gid") != F.col("other")
    neither = (F.col("kept") - F.col("used") - F.col("other_used")).cast("decimal(19,0)") * F.coalesce(_gap("p0", "q0"), F.lit(0)).cast("decimal(19,0)")
    base = groups.join(h, "lang").where(distinct).select(*keys, neither.cast("decimal(38,0)").alias("value"))
    each = counts.select("lang", F.inline("shares"))
    bars = stage_table(each.groupBy("lang", "gid", "p", "p0").agg(F.count(F.lit(1)).alias("m")), "histograms")
    times = F.col("m").cast("decimal(19,0)")
    mine = bars.join(h, "lang").where(distinct).select(*keys, (times * _gap("p", "q0").cast("decimal(19,0)")).alias("value"))
    theirs = bars.select("lang", F.col("gid").alias("other"), F.col("p").alias("q"), "m").join(
        broadcast_if_small(groups.select("lang", "gid", "p0")), "lang").where(distinct)
    theirs = theirs.select(*keys, (times * _gap("p0", "q").cast("decimal(19,0)")).alias("value"))
    both = counts.where(F.size("shares") > 1).select("shares", F.inline("shares")).select(
        "gid", "p", "p0", F.inline(F.transform("shares", lambda x: F.struct(x["gid"].alias("other"), x["p"].alias("q"), x["p0"].alias("q0"))))).where(distinct)
    out = base.unionByName(_exact_sum(_gap("p", "q") - _gap("p", "q0") - _gap("p0", "q") + _gap("p0", "q0"), keys, both))
    for part in (mine, theirs):
        out = out.unionByName(part.groupBy(*keys).agg(F.sum("value").cast("decimal(38,0)").alias("value")))
    return out.groupBy(*keys).agg(F.sum("value").cast("long").alias("value"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, ranks: int = RANKS, text_limit: int = TEXT_BYTES) -> DataFrame:
    """Parts ``pair`` (every other source) and ``term`` (the ``ranks`` terms most above their language) of each group."""
    found, groups = postings(docs, min_docs, text_limit)
    langs = found.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = found.select(F.inline("counts")).groupBy("gid").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("used"))
    g = groups.join(broadcast_if_small(totals), "gid", "left").join(broadcast_if_small(langs), "lang", "left")
    g = g.na.fill(0, ["total", "used", "kept", "lang_total"]).withColumn("p0", _share(F.lit(0)))
    g = stage_table(g, "group-totals")
    known = found.select("lang", "term", "lang_n", F.inline("counts")).join(broadcast_if_small(g), ["lang", "gid"]).withColumn("p", _share("n"))
    names = broadcast_if_small(g.select("gid", *GROUP))
    order = W.partitionBy(*GROUP).orderBy(F.col("value").desc(), F.col("item").asc())
    shares = known.groupBy("lang", "term").agg(F.collect_list(F.struct("gid", "p", "p0")).alias("shares"))
    pairs = pair_values(stage_table(shares, "term-shares"), g).join(names, "gid")
    pairs = pairs.join(broadcast_if_small(g.select(F.col("gid").alias("other"), F.col("source").alias("item"))), "other")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    above = known.withColumn("q", _share("lang_n", "lang_total")).where("p > q")
    top = above.select(*GROUP, F.col("term").alias("item"), _gap("p", "q").alias("value"))
    top = top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks).withColumn("part", F.lit("term"))
    return pairs.select(*GROUP, "part", "item", "value", "rank").unionByName(top.select(*GROUP, "part", "item", "value", "rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: all documents."""
    return divergence(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents),
tok AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM (SELECT lang, term, count(DISTINCT rid) AS n FROM tok GROUP BY lang, term) WHERE n >= 3),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS c FROM tok GROUP BY lang, source, term),
den AS (SELECT grp.lang, grp.source, kept.term, coalesce(cnt.c, 0) AS c FROM grp JOIN kept ON kept.lang = grp.lang
        LEFT JOIN cnt ON cnt.lang = grp.lang AND cnt.source = grp.source AND cnt.term = kept.term),
p AS (SELECT lang, source, term, c, 1 + (CAST(1000000000 AS HUGEINT) * (c + 1)) //
        (sum(c) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p FROM den),
lc AS (SELECT lang, term, sum(c) AS c FROM den GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (c + 1)) // (sum(c) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q FROM lc),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
        FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
tm AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(((p.p - q.q) * (p.p - q.q)) // q.q AS BIGINT) AS value
        FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.c > 0 AND p.p > q.q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM (SELECT * FROM pr UNION ALL SELECT * FROM tm))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""

# Ship this module's Python code with its functions, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
