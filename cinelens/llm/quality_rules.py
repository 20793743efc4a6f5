"""Operator 5 (native): robust multivariate outliers per language and source.

Each document gets a vector of transformed text statistics. For every group of
documents (language, source) the minimum-covariance-determinant estimate of
location and scatter is approached from a deterministic start: concentration
steps keep the half of the vectors (``support``, the method's highest
breakdown) with the smallest Mahalanobis distances; from there the estimate is
taken anew over all vectors within the rejection limit, several times, so it
grows over what is connected with the half and not over clusters apart from it.
The start is the middle and width of the shortest interval that holds half of
each statistic, which bears nearly half of junk; one start only, because among
several the least determinant would favour a tight cluster over the larger rest.
Equal vectors count once in an estimate, so copies of a document do not narrow
it. Every document is judged: it is rejected if its distance to the estimate of
its group exceeds a chi-square quantile. A tight cluster of 40% or more that is
off in a single statistic, by less than about 15 standard deviations, is kept.

Everything runs in DataFrame functions: the statistics are array functions per
document; the estimates are grouped sums (map-side combined, so a group
holding a third of all documents arrives as one row per task); the support cut
is read from a histogram of distances with a fixed number of bins, never by
sorting a group. Estimates are one row per group and are joined by size.

A group with fewer than ``min_group`` different vectors of usable documents
pools with those of its language, a language with fewer with all the rest; a pool that is still too
small rejects nothing. Scatter keeps at least ``FLOORS`` squared on its
diagonal, so a statistic that is the same nearly everywhere (no symbols at
all) does not turn a harmless trace of it into an outlier.

Cases: a null or empty text has no words and fails the base rules; null
language or source are groups of their own; null ids stay null; repeated rows
are judged each for themselves; an empty table gives an empty result; only the
named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import BLANKS, checkpointed

MIN_WORDS, REPEAT_PERCENT = 50, 50
SUPPORT, MIN_GROUP, STEPS, BINS, SALTS = 0.5, 100, 3, 512, 32
#: Times an estimate is taken over all vectors within the limit, after the concentration steps.
GROWTH = 4
#: Chi-square quantile for the rejection, as its upper tail.
TAIL = 1e-6

#: The transformed statistics, each with the least standard deviation it is taken to have.
FLOORS = {"t_length": 0.25, "t_word": 0.06, "t_symbols": 0.08, "t_lines": 0.15, "t_repeats": 0.15}
NAMES = tuple(FLOORS)
_P = len(NAMES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


# --- statistics -------------------------------------------------------------

def _windows(words: str) -> Column:
    return F.expr(f"CASE WHEN size({words}) >= 3 THEN sequence(0, size({words}) - 3) "
                  "ELSE array_remove(array(0), 0) END")


def statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.expr("array_remove(array(''), '')")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+", -1))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    base = docs.select(*keep, words.alias("_w"), lines.alias("_l"),
                       (F.char_length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]")))
                       .cast("long").alias("word_chars"),
                       F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"))
    base = base.select(*keep, "word_chars", "n_symbols", "_w",
                       F.size("_w").cast("long").alias("n_words"),
                       (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                       # bits that hold a window's position
                       F.expr("cast(ceil(log2(size(_w) + 2)) as int)").alias("_k"))
    stats = ["word_chars", "n_symbols", "n_words", "n_dup_lines"]

    # Windows that may repeat: hash in the high bits, position in the low ones; in sorted order
    # equal high bits are neighbours. Positions of the (few) candidates are then compared by words.
    packed = F.sort_array(F.transform(_windows("_w"), _packed))
    packed_rows = base.select(*keep, *stats, "_w", "_k", packed.alias("_p"))
    near = F.expr("""filter(_p, (x, j) ->
        shiftright(x, _k) = shiftright(get(_p, j + 1), _k)
        or coalesce(shiftright(x, _k) = shiftright(get(_p, j - 1), _k), false))""")
    candidates = packed_rows.select(*keep, *stats, "_w", F.transform(
        near, lambda x: x.bitwiseAND(F.expr("shiftleft(1L, _k) - 1L")).cast("int")).alias("_c"))
    triples = F.expr("""array_sort(transform(_c, i ->
        struct(_w[i] as a, _w[i + 1] as b, _w[i + 2] as c, i as i)))""")
    sorted_rows = candidates.select(*keep, *stats, triples.alias("_t"))
    repeated = F.expr("""transform(filter(_t, (x, j) ->
        coalesce(x.a = get(_t, j + 1).a and x.b = get(_t, j + 1).b and x.c = get(_t, j + 1).c, false)
        or coalesce(x.a = get(_t, j - 1).a and x.b = get(_t, j - 1).b and x.c = get(_t, j - 1).c, false)),
        x -> x.i)""")
    placed = sorted_rows.select(*keep, *stats, F.sort_array(repeated).alias("_r"))
    covered = F.expr("""aggregate(transform(_r, (x, j) ->
        least(3L, coalesce(cast(get(_r, j + 1) - x as bigint), 3L))), 0L, (s, x) -> s + x)""")
    return placed.select(*keep, *stats, covered.alias("n_repeat_words"))


def _packed(i: Column) -> Column:
    w = F.col("_w")
    low = F.expr("shiftleft(1L, _k) - 1L")
    h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    return h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def transformed() -> list[Column]:
    """The vector: logarithms, and square roots of shares (which steadies their variance)."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = {
        "t_length": F.log(n + 1),
        "t_word": F.log((F.col("word_chars") + 1) / n),
        "t_symbols": F.sqrt(F.col("n_symbols") / n),
        "t_lines": F.sqrt(F.col("n_dup_lines") / n * 10),
        "t_repeats": F.sqrt(F.col("n_repeat_words") / n),
    }
    return [values[k].alias(k) for k in NAMES]


# --- chi-square -------------------------------------------------------------

def chi2_upper(x: float, p: int) -> float:
    """Upper tail of chi-square with p degrees of freedom (regularised gamma, by series)."""
    a, h = p / 2, x / 2
    if h <= 0:
        return 1.0
    term = total = 1 / a
    k = a
    while term > total * 1e-17:
        k += 1
        term *= h / k
        total += term
    low = total * math.exp(-h + a * math.log(h) - math.lgamma(a))
    return max(0.0, 1 - low)


def chi2_quantile(tail: float, p: int) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_upper(mid, p) > tail else (lo, mid)
    return lo


def consistency(support: float, p: int) -> float:
    """Factor that makes the scatter of the inner ``support`` share that of all, for normal data."""
    return support / (1 - chi2_upper(chi2_quantile(1 - support, p), p + 2))


# --- estimates --------------------------------------------------------------

def _moments(rows: DataFrame, weight: Column) -> DataFrame:
    """Per group: number, mean and scatter (upper triangle) of the weighted rows."""
    t = [F.col(c) for c in NAMES]
    sums = [F.sum(weight).alias("n")] + [F.sum(weight * t[i]).alias(f"s{i}") for i in range(_P)]
    sums += [F.sum(weight * t[i] * t[j]).alias(f"q{i}{j}") for i, j in _PAIRS]
    got = rows.groupBy("grp").agg(*sums).where("n > 0")
    mean = [F.col(f"s{i}") / F.col("n") for i in range(_P)]
    scatter = [(F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]).alias(f"c{i}{j}") for i, j in _PAIRS]
    return got.select("grp", "n", *[mean[i].alias(f"m{i}") for i in range(_P)], *scatter)


def _factored(moments: DataFrame, scale: float) -> DataFrame:
    """Cholesky factor (l..) of the floored scatter, and its log determinant, by expressions."""
    out = moments.select("grp", "n", *[f"m{i}" for i in range(_P)], *[
        (F.greatest(F.col(f"c{i}{j}"), F.lit(0.0)) * scale + FLOORS[NAMES[i]] ** 2 if i == j
         else F.col(f"c{i}{j}") * scale).alias(f"c{i}{j}") for i, j in _PAIRS])
    for j in range(_P):
        head = F.col(f"c{j}{j}")
        for k in range(j):
            head = head - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(head, F.lit(FLOORS[NAMES[j]] ** 2 * 1e-3))))
        for i in range(j + 1, _P):
            v = F.col(f"c{j}{i}")
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", v / F.col(f"l{j}{j}"))
    logdet = sum((2 * F.log(F.col(f"l{j}{j}")) for j in range(_P)), F.lit(0.0))
    cols = [f"m{i}" for i in range(_P)] + [f"l{i}{j}" for i in range(_P) for j in range(i + 1)]
    return out.select("grp", logdet.alias("logdet"), *cols)


def _squared_distance(e: str) -> Column:
    """Squared Mahalanobis distance to the estimate in struct ``e``, by forward substitution."""
    solved: list[Column] = []
    total = F.lit(0.0)
    for i in range(_P):
        v = F.col(NAMES[i]) - F.col(f"{e}.m{i}")
        for k in range(i):
            v = v - F.col(f"{e}.l{i}{k}") * solved[k]
        solved.append(v / F.col(f"{e}.l{i}{i}"))
        total = total + solved[i] * solved[i]
    return total


def _with_distances(rows: DataFrame, estimates: DataFrame, starts: int) -> DataFrame:
    """Rows with d0, d1, ... (squared distances); inner join: rows without an estimate go."""
    joined = rows.join(_salted(estimates), ["grp", "salt"])
    for s in range(starts):
        # array-free substitution in steps, so no expression is repeated
        cols = [c for c in joined.columns if not c.startswith("z")]
        for i in range(_P):
            v = F.col(NAMES[i]) - F.col(f"e{s}.m{i}")
            for k in range(i):
                v = v - F.col(f"e{s}.l{i}{k}") * F.col(f"z{k}")
            joined = joined.withColumn(f"z{i}", v / F.col(f"e{s}.l{i}{i}"))
        total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(_P)), F.lit(0.0))
        joined = joined.select(*cols, total.alias(f"d{s}"))
    return joined.select("grp", "salt", *NAMES, *[f"d{s}" for s in range(starts)])


def _salted(small: DataFrame) -> DataFrame:
    """One row per group and salt, so that a group holding a third of all rows is joined in
    ``SALTS`` parts where the small side is too large to broadcast."""
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _bin(d: Column) -> Column:
    """Bin of a squared distance: logarithmic, a fixed number of bins."""
    return F.least(F.greatest(F.floor((F.log2(d + 1e-9) + 10) * 16), F.lit(0)), F.lit(BINS - 1)).cast("int")


def _cuts(rows: DataFrame, starts: int, support: float) -> DataFrame:
    """Per group, for each start the first bin up to which ``support`` of the rows lie.

    At most groups x starts x BINS rows, whatever the number of documents.
    """
    long = rows.select("grp", F.explode(F.array(*[
        F.struct(F.lit(s).alias("s"), _bin(F.col(f"d{s}")).alias("bin")) for s in range(starts)])).alias("x"))
    counts = long.groupBy("grp", "x.s", "x.bin").agg(F.count("*").alias("n"))
    bins = counts.groupBy("grp", "s").agg(
        F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("h"), F.sum("n").alias("all"))
    cut = F.expr(f"""aggregate(h, struct(0L as seen, cast({BINS} as int) as cut), (a, x) -> struct(
        a.seen + x.n as seen,
        CASE WHEN a.seen < {support} * all AND a.seen + x.n >= {support} * all
             THEN x.bin ELSE a.cut END as cut)).cut""")
    return bins.select("grp", "s", cut.alias("cut")).groupBy("grp").agg(
        *[F.max(F.when(F.col("s") == s, F.col("cut"))).alias(f"cut{s}") for s in range(starts)])


def _structs(estimates: list[DataFrame]) -> DataFrame:
    """One row per group with a struct e0, e1, ... for each start."""
    out = None
    for s, e in enumerate(estimates):
        packed = e.select("grp", F.struct(*[c for c in e.columns if c != "grp"]).alias(f"e{s}"))
        out = packed if out is None else out.join(packed, "grp")
    return out


def _shortest_halves(rows: DataFrame) -> DataFrame:
    """Per group a struct b0, b1, ... for each statistic: width w and middle m of the shortest
    interval between 2% quantiles (by mergeable sketches) that holds half of the rows."""
    at = F.array(*[F.lit(k / 50) for k in range(51)])
    quantiles = rows.groupBy("grp").agg(*[
        F.percentile_approx(c, at, 1000).alias(f"p{i}") for i, c in enumerate(NAMES)])
    return quantiles.select("grp", *[F.expr(f"""array_min(transform(sequence(0, 25), k ->
        struct(p{i}[k + 25] - p{i}[k] as w, (p{i}[k + 25] + p{i}[k]) / 2 as m)))""").alias(f"b{i}")
        for i in range(_P)])


def mcd(rows: DataFrame, support: float = SUPPORT, steps: int = STEPS, growth: int = GROWTH,
        tail: float = TAIL) -> DataFrame:
    """Estimate per group: (grp, e0) with mean, Cholesky factor and log determinant.

    ``rows``: grp and the statistics; equal rows count once.
    """
    # checkpointed rows keep their order, so the salt by row number is the same in every step
    rows = checkpointed(rows.select("grp", *NAMES).distinct()).withColumn(
        "salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    halves = checkpointed(_shortest_halves(rows))
    # 1.349: from the width of the inner half to the standard deviation, for normal data
    far = F.greatest(*[F.abs(F.col(c) - F.col(f"b{i}.m")) / F.greatest(
        F.col(f"b{i}.w") / 1.349, F.lit(FLOORS[c])) for i, c in enumerate(NAMES)])
    near = rows.join(_salted(halves), ["grp", "salt"]).select("grp", "salt", *NAMES, (far * far).alias("d0"))
    scale = consistency(support, _P)
    for _ in range(steps):
        cuts = checkpointed(_cuts(near, 1, support))
        chosen = near.join(_salted(cuts), ["grp", "salt"]).where(_bin(F.col("d0")) <= F.col("cut0"))
        estimates = checkpointed(_structs([_factored(_moments(chosen, F.lit(1.0)), scale)]))
        near = _with_distances(rows, estimates, 1)
    limit, scale = chi2_quantile(tail, _P), consistency(1 - tail, _P)
    for _ in range(growth):
        estimates = checkpointed(_structs([
            _factored(_moments(near.where(F.col("d0") <= limit), F.lit(1.0)), scale)]))
        near = _with_distances(rows, estimates, 1)
    return estimates


def _pooled(usable: DataFrame, group_cols: list[str], min_group: int) -> DataFrame:
    """(group columns, grp): the name of the estimate a group uses, null if its pool is too small."""
    counts = usable.groupBy(*group_cols).agg(F.count("*").alias("n"))
    first = group_cols[0]
    names = counts.withColumn("own", F.to_json(F.array(*[F.col(c).cast("string") for c in group_cols])))
    names = names.withColumn("pool", F.to_json(F.array(F.col(first).cast("string"), F.lit("*"), F.lit("*"))))
    small = F.when(F.col("n") < min_group, F.col("n")).otherwise(0)
    pools = names.groupBy("pool").agg(F.sum(small).alias("pool_n"))
    rest = pools.agg(F.sum(F.when(F.col("pool_n") < min_group, F.col("pool_n")))).first()[0] or 0
    return names.join(pools, "pool").select(
        *group_cols, F.when(F.col("n") >= min_group, F.col("own"))
        .when(F.col("pool_n") >= min_group, F.col("pool"))
        .when(F.lit(rest >= min_group), F.lit("*")).alias("grp"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          group_cols: tuple[str, ...] = ("lang", "source"), support: float = SUPPORT,
          min_group: int = MIN_GROUP, tail: float = TAIL) -> DataFrame:
    """Per row: doc_id, statistics, base_failed, squared distance (null: none), kept."""
    names = [f"g{i}" for i in range(len(group_cols))]
    keep = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[F.col(c).alias(n) for c, n in zip(group_cols, names)])
    stats = statistics(keep, ["doc_id", *names])
    stats = checkpointed(stats.withColumn("base_failed", base_failed()).select("*", *transformed()))
    usable = stats.where(~F.col("base_failed"))
    vectors = checkpointed(usable.select(*names, *NAMES).distinct())
    which = checkpointed(_pooled(vectors, names, min_group))
    right = which.select(*[F.col(n).alias(f"r{n}") for n in names], "grp")
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"r{n}"))
    rows = vectors.join(right, same).where("grp IS NOT NULL").select("grp", *NAMES)
    estimates = mcd(rows, support, tail=tail)
    best = which.join(estimates, "grp", "left").select(*[F.col(n).alias(f"r{n}") for n in names], "e0")
    limit = chi2_quantile(tail, _P)
    found = stats.join(best, same, "left").withColumn("distance", _squared_distance("e0"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", (~F.col("base_failed") & ~F.coalesce(
                            F.col("distance") > limit, F.lit(False))).alias("kept"), "distance")


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept")
