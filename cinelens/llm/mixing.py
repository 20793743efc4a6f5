"""Operator 13: mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule w(t) over the training time 0 <= t <= 1, piecewise linear
between knots. The mix takes as many words as the documents have.

1. Targets. The integral of its schedule is a source's weight. The words are shared out by weight;
   a source stops at ``most_passes`` times its own words and what it cannot take is shared out
   anew by weight among the others, until none is above. Each round is one aggregate over the table
   of sources; the driver sees sums only.
2. Stream. A source's documents, in a seeded order, one pass after another, are its stream of
   words; the target says where the stream ends, so at most one document is cut.
3. Positions. A source's cumulative demand is its target times the integral of its schedule up to t,
   over the whole integral. A document starts where its first word is due: at the t for which the
   cumulative demand is the number of words before it (a quadratic equation per stretch between
   knots, solved in closed form).
4. Range sort. All passes of all documents are range-partitioned and sorted by t; a running sum gives
   the exact number of words before each in the whole training order.

Running sums (of a source's stream, of the training order) are sums per range partition, of which
there are as many as partitions, plus a stream over each sorted partition: no task sees a whole
source. Rows equal in id, source, size and text are counted first and then numbered, in chunks that
are dealt out, so they lie anywhere in the stream like others. The order depends on a checksum of
id, text size and number only: runs agree whatever the partitioning.

Cases: a null text has size 0, and a document of size 0 is taken for 0 words, without a position;
null sources are one source, the last; null ids and repeated rows are documents each; equal
positions are ordered by source and checksum; a source of size 0 has target 0; an empty table gives an empty
result; other columns are carried along by ``in_order`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import checkpointed, prefix_sums

WORD = r"[^\x20\x09-\x0D]+"
MOST_PASSES, SEED, CHUNK = 3, 42, 4096
#: Sources whose table is broadcast; a larger one is joined as Spark sees fit.
FEW_SOURCES = 100_000


@dataclass(frozen=True)
class Schedule:
    """Weight over training time: (t, weight) knots, linear in between, from t = 0 to t = 1."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self):
        ts = [t for t, _ in self.knots]
        if len(ts) < 2 or ts[0] != 0 or ts[-1] != 1 or any(a >= b for a, b in zip(ts, ts[1:])):
            raise ValueError("knots go from 0 to 1 in growing order")
        if any(w < 0 for _, w in self.knots) or not any(w > 0 for _, w in self.knots):
            raise ValueError("weights are not negative, and not all zero")

    def integrals(self) -> list[float]:
        """Integral of the weight from 0 up to each knot."""
        out = [0.0]
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            out.append(out[-1] + (w0 + w1) / 2 * (t1 - t0))
        return out

    def time_of(self, share: Column) -> Column:
        """The t up to which the integral is ``share`` (0 to 1) of the whole."""
        sums = self.integrals()
        due = share * sums[-1]
        out = F.lit(1.0)
        for (t0, w0), (t1, w1), s0, s1 in reversed(list(zip(self.knots, self.knots[1:], sums, sums[1:]))):
            if s1 > s0:
                # w0 x + slope x^2 / 2 = c, in the form that stands a slope of zero and a start of zero
                c, slope = F.greatest(due - s0, F.lit(0.0)), (w1 - w0) / (t1 - t0)
                root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * c, F.lit(0.0)))
                x = F.when(c <= 0, 0.0).otherwise(2 * c / (F.lit(w0) + root))
                out = F.when(due < s1, F.least(t0 + x, F.lit(t1))).otherwise(out)
        return out


#: The query's curriculum: the weights 5, 2, 1 are the integrals; heavy sources fade, light ones grow.
SCHEDULES = (Schedule(((0.0, 7.5), (0.5, 5.0), (1.0, 2.5))), Schedule(((0.0, 2.0), (1.0, 2.0))),
             Schedule(((0.0, 0.25), (0.5, 1.0), (1.0, 1.75))))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, text_key, copies): light records, equal rows counted."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    light = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("text_key"))
    return checkpointed(light.groupBy(*light.columns).agg(F.count("*").alias("copies")))


def cycled(records: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES) -> DataFrame:
    """(source, source_size, source_no, schedule): sources by code point, null last, schedules in turn."""
    sizes = checkpointed(records.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                                       F.lit(1).cast("long").alias("one")))
    ranked = prefix_sums(sizes, [F.col("source").isNull(), F.col("source")], "one", "source_no")
    return ranked.select("source", "source_size", "source_no",
                         F.pmod("source_no", F.lit(len(schedules))).cast("int").alias("schedule"))


def targets(sources: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES,
            most_passes: int = MOST_PASSES) -> DataFrame:
    """Add ``weight`` and ``target``: all words, shared out by weight under the limit of passes."""
    weights = F.lit(0.0)
    for k, s in enumerate(schedules):
        weights = F.when(F.col("schedule") == k, s.integrals()[-1]).otherwise(weights)
    known = checkpointed(sources.withColumn("weight", weights).withColumn("most", most_passes * F.col("source_size")))
    total = known.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    full, rest, weight = F.lit(False), total, None
    reached = -1
    while True:
        held, weight, n = known.select("most", "weight", full.alias("full")).agg(
            F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(F.col("full").cast("long")), F.lit(0))).first()
        rest = total - held
        share = F.col("weight") * float(rest) / F.lit(weight or 1.0)
        if n == reached:
            break
        reached = n
        full = full | (F.col("most") < share)
    return known.withColumn("target", F.when(full, F.col("most").cast("double")).otherwise(share)).drop("most")


def plan(records: DataFrame, sources: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES,
         most_passes: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """One row per pass of every document: its words, its time and its place in the training order.

    (doc_id, source, size, text_key, copy, source_size, target, pass, words, time, first_word);
    a document without any word in the mix has one row with words 0 and no time.
    """
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # copies are numbered in chunks, and the chunks dealt out
    chunks = records.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1,
                                                      F.lit(CHUNK).cast("long"))).alias("chunk"))
    dealt = chunks.repartition(parts, F.xxhash64("doc_id", "text_key", "chunk"))
    single = dealt.select("doc_id", "source", "size", "text_key", F.explode(F.sequence(
        F.col("chunk"), F.least(F.col("chunk") + CHUNK, F.col("copies")) - 1)).alias("copy"))
    # where each source's stream begins among all streams
    own = checkpointed(prefix_sums(checkpointed(sources), [F.col("source_no")], "source_size", "stream_start"))
    few = own.count() <= FEW_SOURCES
    named = own.select(F.col("source").alias("s_source"), "source_size", "source_no", "schedule", "target", "stream_start")
    joined = single.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string"),
                             F.col("copy").cast("string")))
    marked = checkpointed(joined.withColumn("mark", mark))
    placed = prefix_sums(marked, [F.col("source_no"), F.col("mark"), F.col("text_key")], "size", "before")
    start = F.col("before") - F.col("stream_start") + F.col("pass") * F.col("source_size")
    words = F.least(F.col("size"), F.greatest(F.round("target").cast("long") - start, F.lit(0)))
    passes = placed.select("*", F.explode(F.array(*[F.lit(p) for p in range(most_passes)])).alias("pass"))
    taken = passes.select("*", start.alias("start"), words.alias("words")).where("words > 0 OR pass = 0")
    time = F.lit(None).cast("double")
    for k, s in enumerate(schedules):
        time = F.when((F.col("words") > 0) & (F.col("schedule") == k), s.time_of(F.expr("start / nullif(target, 0)"))).otherwise(time)
    timed = checkpointed(taken.select(
        "doc_id", "source", "size", "text_key", "copy", "source_size", "target", "pass", "words", time.alias("time"),
        "source_no", "mark"))
    ordered = prefix_sums(timed, [F.col("time").isNull(), F.col("time"), F.col("source_no"), F.col("mark"),
                                  F.col("text_key"), F.col("pass")], "words", "first_word")
    return ordered.withColumn("first_word", F.when(F.col("words") > 0, F.col("first_word"))).drop("source_no", "mark")


def mix(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, most_passes: int = MOST_PASSES,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The training order of ``docs``: see ``plan``."""
    records = sized(docs, id_col, text_col, source_col)
    return plan(records, targets(cycled(records, schedules), schedules, most_passes), schedules, most_passes, seed)


def in_order(docs: DataFrame, order: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """(first_word, words, row): every taken pass with its document (a struct of all columns),
    range-partitioned and sorted by its place. Of rows equal in id, source and text one stands for all."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("r_id"), F.col(source_col).alias("r_source"), F.xxhash64(text).alias("r_key"),
                       F.struct("*").alias("row")).dropDuplicates(["r_id", "r_source", "r_key"])
    taken = order.where("words > 0")
    return taken.join(rows, F.col("doc_id").eqNullSafe(F.col("r_id")) & F.col("source").eqNullSafe(F.col("r_source"))
                      & (F.col("text_key") == F.col("r_key"))).select("first_word", "words", "row").orderBy("first_word")


def digest(order: DataFrame) -> DataFrame:
    """The columns of the query: one row per document."""
    return order.groupBy("doc_id", "source", "size", "text_key", "copy", "source_size", "target").agg(
        F.sum("words").alias("taken"), F.min("first_word").alias("first_word")).select(
        "doc_id", "size", "source_size", "target", "taken", "first_word")


def _time_sql(schedule: Schedule) -> str:
    """The time at which the integral of the weight reaches ``share`` of the whole."""
    sums, cases = schedule.integrals(), []
    for (t0, w0), (t1, w1), s0, s1 in zip(schedule.knots, schedule.knots[1:], sums, sums[1:]):
        c = f"greatest(share * {sums[-1]!r}::DOUBLE - {s0!r}::DOUBLE, 0::DOUBLE)"
        twice = 2 * ((w1 - w0) / (t1 - t0))
        root = f"sqrt(greatest({w0 * w0!r}::DOUBLE + {twice!r}::DOUBLE * {c}, 0::DOUBLE))"
        cases.append(f"WHEN share * {sums[-1]!r}::DOUBLE < {s1!r}::DOUBLE THEN least({t0!r}::DOUBLE + CASE WHEN {c} <= 0 "
                     f"THEN 0::DOUBLE ELSE 2::DOUBLE * {c} / ({w0!r}::DOUBLE + {root}) END, {t1!r}::DOUBLE)")
    return "CASE " + " ".join(cases) + " ELSE 1::DOUBLE END"


#: DuckDB SQL of the query: the limit on passes in closed form (sources in order of most words by
#: weight; those are full that come before the first that is not).
DIGEST_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         row_number() OVER (ORDER BY doc_id) AS row_no FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS source_no FROM docs GROUP BY source),
weighed AS (
  SELECT *, CAST(list_value(5, 2, 1)[source_no % 3 + 1] AS DOUBLE) AS weight, 3 * source_size AS most FROM sources),
ordered AS (
  SELECT *, (SELECT sum(source_size) FROM weighed)
            - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         row_number() OVER o AS place
  FROM weighed WINDOW o AS (ORDER BY most / weight, source_no)),
first_open AS (
  SELECT min(place) AS place FROM ordered WHERE NOT most < weight * CAST(rest AS DOUBLE) / open_weight),
shared AS (
  SELECT o.*, CASE WHEN o.place < f.place THEN CAST(o.most AS DOUBLE)
                   ELSE o.weight * CAST(x.rest AS DOUBLE) / x.open_weight END AS target
  FROM ordered o, first_open f JOIN ordered x ON x.place = f.place),
placed AS (
  SELECT d.doc_id, d.row_no, d.size, s.source_no, s.source_size, s.target, m.mark,
         coalesce(sum(d.size) OVER (PARTITION BY s.source_no ORDER BY m.mark, d.row_no
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN shared s ON d.source IS NOT DISTINCT FROM s.source,
       LATERAL (SELECT md5(concat_ws(':', '42', CAST(d.doc_id AS VARCHAR), CAST(d.size AS VARCHAR), '0')) AS mark) m),
passes AS (
  SELECT p.*, n.pass, before + n.pass * source_size AS start FROM placed p, (SELECT unnest([0, 1, 2]) AS pass) n),
taken AS (
  SELECT *, greatest(least(size, CAST(round(target) AS BIGINT) - start), 0) AS words,
         CAST(start AS DOUBLE) / target AS share FROM passes),
timed AS (
  SELECT *, CASE source_no % 3 WHEN 0 THEN """ + _time_sql(SCHEDULES[0]) + """
                 WHEN 1 THEN """ + _time_sql(SCHEDULES[1]) + """
                 ELSE """ + _time_sql(SCHEDULES[2]) + """ END AS due FROM taken WHERE words > 0),
in_order AS (
  SELECT row_no, words, coalesce(sum(words) OVER (ORDER BY due, source_no, mark, row_no, pass
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_word FROM timed)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(sum(o.words), 0) AS BIGINT) AS taken,
       CAST(min(o.first_word) AS BIGINT) AS first_word
FROM placed p LEFT JOIN in_order o ON p.row_no = o.row_no
GROUP BY p.row_no, p.doc_id, p.size, p.source_size, p.target"""
