"""Mixing sources to target weights by a time-varying curriculum (native).

Each source has a weight schedule over training time ``t`` in [0, 1].  Its
integral is the demand for the source's words; the inverse of that integral
turns "so many words of this source are used up" into the time at which the
next document is due.  Documents of all sources are then range-sorted by that
time.  Everything is DataFrame expressions: no Python runs on executors.

Schedules are linear: source weight at ``t`` is ``1 + slope * (1 - 2t)``
times its mean, with ``|slope| < 1``; demand up to ``t`` is
``(1 + slope) * t - slope * t**2`` of the target, which is inverted in closed
form.  Slopes repeat over the sources as the weights do: early, late, even.

Order inside a source is by MD5 of the id, so reruns agree.  Running totals
come in two steps, so that no source is ordered in one task: sums of the 4096
ranges of the MD5's first 12 bits, then the order inside each range.

Defined results: a null text has size 0; a null source is a source, sorted
last; repeated rows each count; a source whose documents are all empty has
target 0; a document that is not read has no positions; an empty table gives an
empty frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SLOPES = (0.6, -0.6, 0.0)


def _pick(values: tuple[float, ...], at) -> F.Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (at % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """Per source: source_size, target, slope.  One row a source is sorted in
    one task; documents never are.

    ``share`` of all words is divided by weight; a target above ``most`` times
    its source is cut to that and the excess divided again by weight, until
    none is above.  That is the level L with ``sum(min(cap, L * weight))``
    equal to the demand; sources reach their caps in order of cap / weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("_rank", F.row_number().over(order) - 1)
    per = per.withColumns({"_w": _pick(weights, F.col("_rank")), "slope": _pick(slopes, F.col("_rank")), "_cap": F.col("source_size") * F.lit(float(most))})
    filled = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before, whole = filled.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumns({
        "_need": F.sum("source_size").over(whole) * F.lit(float(share)),
        "_capped": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
        "_open": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)),
    })
    # the first source, in order of filling, that keeps below its cap sets the level for all after it
    level = F.when((F.col("_need") - F.col("_capped")) / F.col("_open") * F.col("_w") < F.col("_cap"), (F.col("_need") - F.col("_capped")) / F.col("_open"))
    per = per.withColumn("_level", F.first(level, ignorenulls=True).over(filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return per.select("source", "source_size", F.least("_cap", F.coalesce(F.col("_level") * F.col("_w"), "_cap")).alias("target"), "slope")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text, source): doc_id, size,
    source_size, target, taken, positions, position, last_position; range-sorted by position.

    A source is read in whole passes of its order and one partial pass: a
    document is read again if the words before it, plus half its own, are
    within the words still wanted.  ``taken`` is size times the passes,
    ``positions`` the times of its readings, ``position`` and ``last_position``
    the first and last of them (null if none).
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("_key"))
    sized = sized.withColumn("_range", F.substring("_key", 1, 3))
    targets = source_targets(sized.select("source", "size"), weights, share, most, slopes).withColumnRenamed("source", "_source")

    ranges = sized.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    upto = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("_s"), F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_base"))
    ranges = ranges.join(targets, F.col("_s").eqNullSafe(F.col("_source"))).drop("_source")
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = sized.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = out.join(ranges, (F.col("_range") == F.col("_r")) & F.col("source").eqNullSafe(F.col("_s")))

    start = F.col("_base") + F.col("_inside")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("_passes") * F.col("source_size")
    again = F.when(F.col("_start") + F.col("size") / 2 < F.col("_rest"), 1).otherwise(0)
    out = out.withColumns({"_start": start, "_passes": passes}).withColumn("_rest", rest).withColumn("_reads", F.col("_passes") + again)
    out = out.withColumn("taken", (F.col("size") * F.col("_reads")).cast("long"))
    times = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_reads").cast("long") - 1),
        lambda k: due_time((k * F.col("source_size") + F.col("_start")) / F.col("target"), F.col("slope")),
    )
    out = out.withColumn("positions", F.when((F.col("_reads") > 0) & (F.col("target") > 0), times).otherwise(F.array().cast("array<double>")))
    out = out.withColumns({"position": F.get("positions", F.lit(0)), "last_position": F.try_element_at("positions", F.lit(-1))})
    return out.select("doc_id", "size", "source_size", "target", "taken", "positions", "position", "last_position").orderBy("position", "doc_id")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per reading of a mix: doc_id, size, position, reading (0, 1, ...), range-sorted by position."""
    readings = mixed.select("doc_id", "size", F.posexplode("positions").alias("reading", "position"))
    return readings.select("doc_id", "size", "position", "reading").orderBy("position", "doc_id", "reading")


def due_time(part: F.Column, slope: F.Column) -> F.Column:
    """Time at which ``part`` (0 to 1) of a source's demand is used up: the
    inverse of ``(1 + slope) * t - slope * t**2``, the integral of its schedule."""
    p = F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0))
    root = F.sqrt(F.greatest((1 + slope) * (1 + slope) - 4 * slope * p, F.lit(0.0)))
    return F.least(2 * p / ((1 + slope) + root), F.lit(1.0))


#: The rows of op10 as DuckDB SQL; positions are in billionths of the training time.
ORACLE = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS k FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap, [5.0::DOUBLE, 2.0, 1.0][(r % 3 + 1)::INT] AS w, [0.6::DOUBLE, -0.6::DOUBLE, 0.0::DOUBLE][(r % 3 + 1)::INT] AS slope FROM per),
fill AS (
  SELECT 0 AS step, source, source_size, cap, w, slope, false AS capped, 1.5::DOUBLE * sum(source_size) OVER () AS need FROM weighed
  UNION ALL
  SELECT step + 1, source, source_size, cap, w, slope, capped OR level * w > cap, need FROM (
    SELECT *, (need - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0)) / sum(w) FILTER (WHERE NOT capped) OVER () AS level FROM fill) x
  WHERE step < 30),
final AS (
  SELECT source, source_size, slope, CASE WHEN capped THEN cap ELSE w * (need - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0)) / sum(w) FILTER (WHERE NOT capped) OVER () END AS target
  FROM fill WHERE step = 30),
placed AS (
  SELECT s.*, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM sized s),
joined AS (
  SELECT p.doc_id, p.size, f.source_size, f.target, f.slope, p.start, CASE WHEN f.source_size > 0 THEN floor(f.target / f.source_size) ELSE 0 END AS passes
  FROM placed p JOIN final f ON p.source IS NOT DISTINCT FROM f.source),
chosen AS (
  SELECT *, (passes + CASE WHEN start + size / 2.0 < target - passes * source_size THEN 1 ELSE 0 END)::BIGINT AS reads FROM joined),
timed AS (
  SELECT *, list_transform(range(CASE WHEN target > 0 THEN reads ELSE 0 END),
    lambda i: least(greatest((i * source_size + start)::DOUBLE / target, 0.0::DOUBLE), 1.0::DOUBLE)) AS parts FROM chosen),
due AS (
  SELECT *, list_transform(parts, lambda p: least(2 * p / ((1 + slope) + sqrt(greatest((1 + slope) * (1 + slope) - 4 * slope * p, 0.0::DOUBLE))), 1.0::DOUBLE)) AS times FROM timed)
SELECT doc_id, size, source_size, round(target, 4) AS target, size * reads AS taken, round(times[1], 9) AS position, round(times[-1], 9) AS last_position,
  coalesce(array_to_string(list_transform(times, lambda t: round(t * 1e9::DOUBLE)::BIGINT), ','), '') AS positions FROM due
"""
