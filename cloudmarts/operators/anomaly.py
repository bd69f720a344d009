"""Per-group interquartile fences and the cost-anomaly flag.

Quartiles are exact at any size and without a hot group.  One pass builds a mergeable quantile
sketch per group; a group of at most ``sketch_k`` values is settled by it, as such a sketch holds
every value.  For larger groups the sketch bounds each quartile between two values a fraction of
a percent of the ranks apart, and a second pass counts the few rows between them value by value
and all others per gap, which settles the exact rank.  Only groups so large that even that part
is beyond ``rank_rows`` are sketched again inside their bounds first.  Values are compared, never
calculated with, so infinite and subnormal ones need no care.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks import staged
from .joins import DEFAULT_BROADCAST_BYTES, checked_broadcast
from .sketches import SALTS, SKETCH_K, rank_error, sketch_groups

RANK_ROWS = 100_000  # so many rows of a group are ranked value by value
GRID = 256           # places of a sketch that a narrower range may begin or end at
MAX_PASSES = 60      # each narrows every open range by far; more mean a fault


def group_quantiles(df: DataFrame, value_col: str, group_col: str, shares: dict[str, float],
                    sketch_k: int = SKETCH_K, rank_rows: int = RANK_ROWS) -> DataFrame:
    """One row per non-null group: the smallest value whose cumulative share reaches each of
    ``shares`` (name -> share).  Null and NaN values are left out, and groups without others.

    Infinite values are ordinary smallest and largest ones; -0.0 counts as 0.0.
    """
    known = _known(df, value_col, group_col)
    return _narrowed(known, sketch_groups(known, ["g"], "x", sketch_k), group_col, shares, sketch_k, rank_rows)


def sketched_quantiles(df: DataFrame, sketches: DataFrame, value_col: str, group_col: str, shares: dict[str, float],
                       sketch_k: int = SKETCH_K, rank_rows: int = RANK_ROWS) -> DataFrame:
    """``group_quantiles`` of ``df`` where ``sketches`` (group, n, sketch) of the same rows are
    there already: the rows are read only if a group has more than ``sketch_k`` of them."""
    return _narrowed(_known(df, value_col, group_col), sketches.withColumnRenamed(group_col, "g"), group_col, shares,
                     sketch_k, rank_rows)


def _known(df: DataFrame, value_col: str, group_col: str) -> DataFrame:
    rows = df.select(F.col(group_col).alias("g"), (F.col(value_col).cast("double") + F.lit(0.0)).alias("x"))
    return rows.where(F.col("g").isNotNull() & F.col("x").isNotNull() & ~F.isnan("x"))


def _narrowed(known: DataFrame, sketches: DataFrame, group_col: str, shares: dict[str, float], sketch_k: int,
              rank_rows: int) -> DataFrame:
    if sketch_k < 64:
        raise ValueError("a sketch this small may not narrow a range")
    names = list(shares)
    ranges = staged(sketches.select("g", *[
        c for i, p in enumerate(shares.values()) for c in _first_range(i, float(p), sketch_k)]), "quantile-ranges")
    settled = " AND ".join(f"size{i} = 0" for i in range(len(names)))
    wide = " OR ".join(f"size{i} > {rank_rows}" for i in range(len(names)))
    done = []
    for _ in range(MAX_PASSES):
        done.append(ranges.where(settled))
        left = ranges.where(f"NOT ({settled})")
        n_left, n_wide = left.agg(F.count("*"), F.count_if(F.expr(wide))).head()
        if not n_left:
            break
        step = _sketch_inside if n_wide else _count_inside
        ranges = staged(step(known, left, len(names), sketch_k), "quantile-ranges")
    else:
        raise RuntimeError(f"quantiles are still open after {MAX_PASSES} passes")
    final = done[0]
    for d in done[1:]:
        final = final.unionByName(d)
    return final.select(F.col("g").alias(group_col), *[F.col(f"lo{i}").alias(n) for i, n in enumerate(names)])


def _first_range(i: int, share: float, sketch_k: int) -> list:
    """k, lo, hi and size of a target: the value of rank k lies between lo and hi, with about
    ``size`` rows between them; size 0 tells that it is lo.  A sketch that holds all values of its
    group settles it; any other sets two rank errors to each side."""
    n, margin = F.col("n"), 2 * rank_error(sketch_k)

    def at(place: float):
        return F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, place))))

    return [F.greatest(F.lit(1), F.ceil(F.lit(share) * n)).cast("bigint").alias(f"k{i}"),
            F.when(n <= sketch_k, at(share)).otherwise(at(share - margin)).alias(f"lo{i}"),
            F.when(n <= sketch_k, at(share)).otherwise(at(share + margin)).alias(f"hi{i}"),
            F.when(n <= sketch_k, F.lit(0)).otherwise(1 + n * (2 * margin)).cast("bigint").alias(f"size{i}")]


def _with_ranges(known: DataFrame, ranges: DataFrame) -> DataFrame:
    t = checked_broadcast(ranges.withColumnRenamed("g", "tg"))
    return known.join(t, F.col("g") == F.col("tg")).drop("tg")


def _sketch_inside(known: DataFrame, ranges: DataFrame, n_names: int, sketch_k: int) -> DataFrame:
    """Narrower ranges from sketches of the rows strictly inside the present ones, in one pass;
    the rows below and at both ends are counted, so equal values at an end settle a target."""
    counted, merged, columns = [], [], []
    for i in range(n_names):
        x, lo, hi = F.col("x"), F.col(f"lo{i}"), F.col(f"hi{i}")
        inside = (x > lo) & (x < hi)
        counted += [F.count_if(x < lo).alias(f"below{i}"), F.count_if(x == lo).alias(f"low{i}"),
                    F.count_if(inside).alias(f"n{i}"), F.count_if((x == hi) & (hi > lo)).alias(f"high{i}"),
                    F.kll_sketch_agg_double(F.when(inside, x), F.lit(sketch_k)).alias(f"sketch{i}"),
                    *[F.first(f"{c}{i}").alias(f"{c}{i}") for c in ("k", "lo", "hi")]]
        merged += [*[F.sum(f"{c}{i}").alias(f"{c}{i}") for c in ("below", "low", "n", "high")],
                   F.kll_merge_agg_double(f"sketch{i}", F.lit(sketch_k)).alias(f"sketch{i}"),
                   *[F.first(f"{c}{i}").alias(f"{c}{i}") for c in ("k", "lo", "hi")]]
    found = (_with_ranges(known, ranges).groupBy("g", (F.spark_partition_id() % SALTS).alias("salt")).agg(*counted)
             .groupBy("g").agg(*merged))
    margin = 2 * rank_error(sketch_k)
    for i in range(n_names):
        below, low, n, high, lo, hi = (F.col(f"{c}{i}") for c in ("below", "low", "n", "high", "lo", "hi"))
        rank = F.col(f"k{i}") - below - low  # among the rows inside
        points = F.kll_sketch_get_quantile_double(f"sketch{i}", F.array(*[F.lit(j / GRID) for j in range(GRID + 1)]))
        first = F.greatest(F.lit(0), F.floor((rank / n - margin) * GRID)).cast("int")
        last = F.least(F.lit(GRID), F.ceil((rank / n + margin) * GRID)).cast("int")
        # a sketch's bounds may miss the rank (once in very many): then it is sought beyond them
        cases = [(F.col(f"k{i}") <= below, float("-inf"), lo, F.lit(1 << 62)), (rank <= 0, lo, lo, F.lit(0)),
                 (rank <= n, points[first], points[last], 1 + n * (2 * margin + 2 / GRID)),
                 (rank <= n + high, hi, hi, F.lit(0)), (F.lit(True), hi, float("inf"), F.lit(1 << 62))]
        for at, name in ((1, "lo"), (2, "hi"), (3, "size")):
            case = F
            for row in cases:
                case = case.when(row[0], row[at] if at < 3 else row[at].cast("bigint"))
            columns.append(case.alias(f"{name}{i}"))
    return found.select("g", *[f"k{i}" for i in range(n_names)], *columns)


def _count_inside(known: DataFrame, ranges: DataFrame, n_names: int, sketch_k: int) -> DataFrame:
    """The value of each rank: rows inside a range are counted per value, those outside per gap
    between ranges.  Where the rank falls into a gap, the gap is the next range."""
    rows = _with_ranges(known, ranges)
    inside, gap = F.lit(False), F.lit(0)
    for i in range(n_names):
        inside = inside | F.col("x").between(F.col(f"lo{i}"), F.col(f"hi{i}"))
        gap = gap + (F.col("x") > F.col(f"hi{i}")).cast("int")
    cells = (rows.groupBy("g", F.when(inside, F.col("x")).alias("value"), F.when(~inside, gap).alias("gap"))
             .agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    upto = F.sum("n").over(Window.partitionBy("g").orderBy("lo").rowsBetween(Window.unboundedPreceding, 0))
    ranked = cells.withColumn("upto", upto).join(
        ranges.select("g", *[f"k{i}" for i in range(n_names)]), "g")
    columns = [F.first(f"k{i}").alias(f"k{i}") for i in range(n_names)]
    for i in range(n_names):
        here = (F.col("upto") >= F.col(f"k{i}")) & (F.col("upto") - F.col("n") < F.col(f"k{i}"))
        open_rows = F.when(F.col("lo") < F.col("hi"), F.col("n")).otherwise(0)
        columns += [F.max(F.when(here, F.col("lo"))).alias(f"lo{i}"), F.max(F.when(here, F.col("hi"))).alias(f"hi{i}"),
                    F.max(F.when(here, open_rows)).alias(f"size{i}")]
    return ranked.groupBy("g").agg(*columns)


def group_quartiles(df: DataFrame, value_col: str = "daily_cost_usd",
                    group_col: str = "service") -> DataFrame:
    """q1, q3 of ``value_col`` per group."""
    return group_quantiles(df, value_col, group_col, {"q1": 0.25, "q3": 0.75})


def iqr_bounds(quartiles: DataFrame, k: float = 1.5,
               zero_iqr_margin: float = 10.0) -> DataFrame:
    """Tukey fences q3 + k*iqr and q1 - k*iqr; a zero IQR widens to +/- margin."""
    iqr = F.col("q3") - F.col("q1")
    zero = iqr == 0.0
    return quartiles.withColumns({
        "iqr": iqr,
        "upper_bound": F.when(zero, F.col("q3") + zero_iqr_margin).otherwise(F.col("q3") + k * iqr),
        "lower_bound": F.when(zero, F.col("q1") - zero_iqr_margin).otherwise(F.col("q1") - k * iqr),
    })


def anomaly_flag(value_col: str = "daily_cost_usd"):
    """Strictly outside a fence; missing fences never flag."""
    v = F.col(value_col)
    return F.coalesce((v > F.col("upper_bound")) | (v < F.col("lower_bound")), F.lit(False))


def fences(df: DataFrame, value_col: str = "daily_cost_usd", group_col: str = "service",
           k: float = 1.5, zero_iqr_margin: float = 10.0,
           max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """One row per group: upper_bound, lower_bound; computed once (checkpointed), measured,
    then marked for broadcast."""
    bounds = iqr_bounds(group_quartiles(df, value_col, group_col), k, zero_iqr_margin)
    return checked_broadcast(bounds.select(group_col, "upper_bound", "lower_bound"),
                             max_broadcast_bytes, compute_once=True)


def flag_anomalies(df: DataFrame, value_col: str = "daily_cost_usd", group_col: str = "service",
                   bounds: DataFrame | None = None) -> DataFrame:
    """Adds upper_bound, lower_bound, anomaly_flag to every row of ``df``.

    ``bounds`` (from ``fences``) may come from a narrower frame than ``df``, e.g. from the
    events before they are joined.  One row per group is joined, so the big side is never
    shuffled on a low-cardinality key.  A NULL group matches no fence and is never flagged.
    """
    if bounds is None:
        bounds = fences(df, value_col, group_col)
    return df.join(bounds, group_col, "left").withColumn("anomaly_flag", anomaly_flag(value_col))
