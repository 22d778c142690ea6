r"""Mixing sources to target weights by hash thresholds, without sorting rows.

Every document has a hash of its id.  A source whose target is below its size
takes the documents whose hash lies below a threshold; one whose target is
above takes all of them once and those below a threshold a second time.  The
threshold comes from histograms: words summed by source and hash bucket, the
bucket in which the running sum crosses the budget, and the same again inside
that bucket alone, until the crossing hash is known (``SHIFTS``).  The document
there gives just the words still missing, so a source meets its target to a word;
documents that agree in their hash share what is missing in proportion.
``mixed_whole`` cuts no text: documents that agree in their hash go by a second
one, of id and text, and the last one is taken whole if that comes nearer.

Size: words ``[^\x20\x09-\x0D]+`` of the text, 0 for a null or empty one.  Null
sources form the last source; an empty table gives no rows.  Repeated rows have
one hash and are taken alike.  ``mix`` reads the id, the text and the source alone;
``mixed`` carries all columns, whatever their names (its own begin with ``__``).  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Weights of the sources by code point, in turn.  Fixed values of the mix.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_COPIES = 2
#: Hash bits below the bucket at each level: 2^12 buckets a source, 2^12 inside the
#: crossing one, then single hashes inside that (one in 2^24 of a source).
HASH_BITS = 60
SHIFTS = (48, 36, 0)
#: A table of the sources is broadcast up to this many rows, and joined beyond.
BROADCAST_SOURCES = 50_000

_BLANK = r"[\x20\x09-\x0D]"


def n_words(column: str) -> Column:
    """Words of a text: parts between blanks, without an empty first or last one."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    parts = F.split(text, _BLANK + "+")
    blank_ends = (F.when(parts[0] == "", 1).otherwise(0)
                  + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0))
    return (F.size(parts) - blank_ends).cast("long")


def hash60(key: str) -> Column:
    """60 bits of the id's md5 (a hash that other engines have too)."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _sources(table: DataFrame) -> DataFrame:
    """A checkpointed table of one row per source, ready for a join by source."""
    return F.broadcast(table) if table.count() <= BROADCAST_SOURCES else table


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from one row per source.

    The sources share ``SHARE_PERCENT`` of all words by weight; a target stops at
    ``MOST_COPIES`` times its source's size and the excess is shared again.  The
    end of that is ``target = min(cap, level * weight)``: in the order of
    ``cap / weight``, a source is capped while the words left, spread over the
    weights left, reach its cap.  The windows without a key sort this list of
    sources, never documents.
    """
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in WEIGHTS])[
        F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS)))]
    rows = (sizes.withColumn("weight", weight)
            .withColumn("cap", (F.col("source_size") * MOST_COPIES).cast("double"))
            .withColumn("reach", F.col("cap") / F.col("weight")))
    before = (Window.orderBy("reach", F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    words_left = (F.sum("source_size").over(whole) * F.lit(SHARE_PERCENT) / F.lit(100.0)
                  - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    weights_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", words_left / weights_left)
    capped = F.col("reach") <= F.col("level")
    level = F.min(F.when(~capped, F.struct("reach", "level"))).over(whole)["level"]
    return rows.select("source", "source_size",
                       F.when(capped, F.col("cap"))
                       .otherwise(F.least("cap", F.col("weight") * level)).alias("target"))


def thresholds(sized: DataFrame) -> DataFrame:
    """Per source its size, target, whole passes (``full``) and threshold.

    A document is taken in the last pass if its hash is below ``limit``; those
    whose hash equals it share ``rest`` of their ``tied`` words.  ``sized`` has
    rows ``source, size, h`` and is read once per level.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = targets(sizes).select(
        "source", "source_size", "target",
        ((F.col("source_size") > 0) & (F.col("target") >= F.col("source_size")))
        .cast("long").alias("full"))
    return _crossings(sized, state.select(
        "*", (F.floor("target") - F.col("full") * F.col("source_size")).alias("rest")))


def _crossings(sized: DataFrame, state: DataFrame) -> DataFrame:
    """Adds ``limit`` and ``tied`` of the budget ``rest`` of each source, and makes ``rest`` what is left."""
    kept = [c for c in state.columns if c != "rest"]
    state = cut_lineage(state.select(
        *kept, F.lit(0).cast("long").alias("limit"), F.lit(0).cast("long").alias("tied"), "rest"))
    above = HASH_BITS
    for shift in SHIFTS:
        inside = _sources(state.select(F.col("source").alias("s"), F.col("limit").alias("open"),
                                       F.col("rest").alias("budget")))
        hist = (sized.join(inside, F.col("source").eqNullSafe(F.col("s")))
                .where(F.shiftright("h", above) == F.col("open"))
                .groupBy("source", "budget", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words")))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        crossing = (hist.withColumn("upto", upto).where(F.col("upto") > F.col("budget"))
                    .groupBy(F.col("source").alias("s"))
                    .agg(F.min(F.struct("bucket", "words",
                                        (F.col("budget") - F.col("upto") + F.col("words"))
                                        .alias("rest"))).alias("x")))
        # no crossing: all of the pass is taken, up to the end of the hashes
        state = cut_lineage(
            state.join(crossing, F.col("source").eqNullSafe(F.col("s")), "left").select(
                *kept, F.coalesce("x.bucket", F.lit(1 << (HASH_BITS - shift)).cast("long")).alias("limit"),
                F.coalesce("x.words", F.lit(0).cast("long")).alias("tied"),
                F.coalesce("x.rest", F.lit(0).cast("long")).alias("rest")))
        above = shift
    return state


def _with_taken(sized: DataFrame, state: DataFrame) -> DataFrame:
    """Adds the source's row of ``state`` (names after ``__at_``) and ``__taken``."""
    limits = _sources(state.select(*[F.col(c).alias(f"__at_{c}") for c in state.columns]))
    last = (F.when(F.col("__h") < F.col("__at_limit"), F.col("__size"))
            .when((F.col("__h") == F.col("__at_limit")) & (F.col("__at_tied") > 0),
                  F.floor(F.col("__at_rest") * F.col("__size") / F.col("__at_tied")))
            .otherwise(F.lit(0).cast("long")))
    return (sized.join(limits, F.col("__source").eqNullSafe(F.col("__at_source")))
            .withColumn("__taken", F.col("__at_full") * F.col("__size") + last))


def _sized(docs: DataFrame, key: str, column: str, source: str, *carry: str) -> DataFrame:
    return docs.select(*carry, F.col(source).cast("string").alias("__source"),
                       n_words(column).alias("__size"), hash60(key).alias("__h"))


def mix(docs: DataFrame, key: str = "doc_id", column: str = "text",
        source: str = "source") -> DataFrame:
    """``key, size, source_size, target, taken`` of every document."""
    narrow = cut_lineage(_sized(docs, key, column, source, key))
    state = thresholds(narrow.select(F.col("__source").alias("source"),
                                     F.col("__size").alias("size"), F.col("__h").alias("h")))
    return _with_taken(narrow, state).select(
        key, F.col("__size").alias("size"), F.col("__at_source_size").alias("source_size"),
        F.col("__at_target").alias("target"),
        F.col("__taken").cast("long").alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", column: str = "text",
          source: str = "source") -> DataFrame:
    """The documents of the mix, all columns: one row for each pass that takes words of it.

    A document that a pass takes in part is cut behind its last word taken.
    """
    state = thresholds(_sized(docs, key, column, source).select(
        F.col("__source").alias("source"), F.col("__size").alias("size"),
        F.col("__h").alias("h")))
    rows = _with_taken(_sized(docs, key, column, source, *docs.columns), state)
    copy = F.explode(F.sequence(F.lit(0), F.lit(MOST_COPIES - 1))).alias("__pass")
    rows = rows.where("__taken > 0").select("*", copy)
    words = F.least(F.col("__size"), F.col("__taken") - F.col("__pass") * F.col("__size"))
    rows = rows.withColumn("__words", words).where("__words > 0")
    # parts: blanks before the first word, then each word with the blanks behind it
    parts = F.split(F.col(column), rf"(?<={_BLANK})(?!{_BLANK})")
    lead = F.when(F.col(column).rlike("^" + _BLANK), 1).otherwise(0)
    cut = F.array_join(F.slice(parts, F.lit(1), (F.col("__words") + lead).cast("int")), "")
    text = F.when(F.col("__words") == F.col("__size"), F.col(column)).otherwise(cut)
    return rows.withColumn(column, text).select(*docs.columns)


def _second_hash(key: str, column: str) -> Column:
    """60 bits of the md5 of id and text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    whole = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("\n"), text)
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def mixed_whole(docs: DataFrame, key: str = "doc_id", column: str = "text",
                source: str = "source") -> DataFrame:
    """The mix in whole documents, all columns: one row for each pass that takes a document.

    A source misses its target by at most half of the document on the threshold.  Rows
    of one id and text are taken alike.  Words are counted once, into a narrow checkpoint;
    beyond that only the texts on a threshold are counted and hashed.
    """
    rows = docs.select(*docs.columns, F.col(source).cast("string").alias("__source"),
                       hash60(key).alias("__h"))
    narrow = cut_lineage(_sized(docs, key, column, source))
    state = thresholds(narrow.select(F.col("__source").alias("source"), F.col("__size").alias("size"),
                                     F.col("__h").alias("h")))
    limits = _sources(state.select(*[F.col(c).alias(f"__at_{c}") for c in ("source", "full", "limit")]))
    of_source = F.col("__source").eqNullSafe(F.col("__at_source"))
    tied = cut_lineage(rows.join(limits, of_source).where("__h = __at_limit").select(
        F.col("__source").alias("source"), n_words(column).alias("size"),
        _second_hash(key, column).alias("h")))
    state = _crossings(tied, state.select("source", "full", F.col("limit").alias("first"), "rest"))
    limits = _sources(state.select(*[F.col(c).alias(f"__at_{c}") for c in state.columns]))
    second = F.col("__second")
    near = (second < F.col("__at_limit")) | (
        (second == F.col("__at_limit")) & (2 * F.col("__at_rest") >= F.col("__at_tied")))
    some_word = F.coalesce(F.col(column).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = rows.join(limits, of_source).where(some_word)
    rows = rows.withColumn("__second", F.when(F.col("__h") == F.col("__at_first"),
                                              _second_hash(key, column)))
    last = (F.col("__h") < F.col("__at_first")) | F.coalesce(near, F.lit(False))
    rows = rows.withColumn("__passes", F.col("__at_full") + last.cast("long")).where("__passes > 0")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__passes"))).alias("__pass")
    return rows.select(*docs.columns, each).select(*docs.columns)


def op4_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Mix all documents; see the module text for ties and empty texts."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS h
      FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
             WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
      FROM d GROUP BY source),
c AS (SELECT *, CAST(2 * source_size AS DOUBLE) AS cap,
        CAST(2 * source_size AS DOUBLE) / weight AS reach FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () * 150 AS DOUBLE) / 100.0::DOUBLE
                 - coalesce(sum(cap) OVER p, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0)) AS level
      FROM c WINDOW p AS (ORDER BY reach, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT arg_min(level, reach) AS lv FROM l WHERE reach > level),
g AS (SELECT source, source_size,
        CASE WHEN reach <= level THEN cap ELSE least(cap, weight * u.lv) END AS target
      FROM l LEFT JOIN u ON true),
b AS (SELECT *, CASE WHEN source_size > 0 AND target >= source_size THEN 1 ELSE 0 END AS f FROM g),
hs AS (SELECT source, h, sum(size) AS words,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY source, h)
SELECT d.doc_id, d.size, b.source_size, b.target,
  CAST(b.f * d.size + CASE
    WHEN hs.upto <= floor(b.target) - b.f * b.source_size THEN d.size
    WHEN hs.upto - hs.words < floor(b.target) - b.f * b.source_size
      THEN floor((floor(b.target) - b.f * b.source_size - hs.upto + hs.words) * d.size / hs.words)
    ELSE 0 END AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN hs ON hs.source IS NOT DISTINCT FROM d.source AND hs.h = d.h
"""
