"""Drift of data: two-sample tests per column, stability index, summaries, history.

All functions compare a reference table with a current table, optionally per group
(``by``, for example the week) of the current one, and return one row per (``by``,
column). Groups are keys of one job, not a loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.names import classify, column, require
from tidegauge.functions.significance import chi_squared_p, kolmogorov_p, psi_term
from tidegauge.functions.values import nan_to_null
from tidegauge.operators.order_stats import (
    Grid,
    as_position,
    build_grid,
    doubles,
    in_cells,
    long_cells,
    quantile_values,
)
from tidegauge.session import checkpointed

ALPHA = 0.05
EMPTY_BUCKET_ROWS = 1e-6


def _gap(r: Column, c: Column) -> Column:
    return F.abs(r / F.col("nr") - c / F.col("nc"))


def _settled(line: DataFrame, keys: Sequence[str], known: Column | None = None) -> DataFrame:
    """Add ``best``, the largest gap at a border so far, and ``most``, a bound inside.

    ``line`` has reference and current rows before (``r0, c0``) and up to (``r1, c1``) each
    cell. Both distribution functions only grow in between, so no inner point is further
    apart than opposite corners.
    """
    r0, r1, c0, c1 = (F.col(x) for x in ("r0", "r1", "c0", "c1"))
    border = F.greatest(_gap(r0, c0), _gap(r1, c1))
    best = F.max(border).over(Window.partitionBy(*[column(c) for c in keys]))
    return line.withColumns(
        {
            "best": best if known is None else F.greatest(best, known),
            "most": F.greatest(_gap(r1, c0), _gap(r0, c1)),
        }
    )


def _opened_rows(ref: DataFrame, cur: DataFrame, cells: DataFrame, place: Sequence[str], level: Sequence[str]) -> DataFrame:
    """Rows of both sides in open cells, counted by ``level`` (``part`` or ``value``).

    ``cells`` is stored and counted before it is joined.
    """
    size = cells.count()
    spots = ["ix", *place]
    at = [c for c in cells.columns if c not in spots]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    names = list(dict.fromkeys((*place, *level)))
    from_ref = in_cells(ref.select("ix", *names, one.alias("r")), cells, spots, size).withColumn("c", none)
    from_cur = in_cells(cur.select("ix", *names, one.alias("c")), cells, spots, size).withColumn("r", none)
    keys = [column(c) for c in dict.fromkeys((*spots, *at, *level))]
    return from_ref.unionByName(from_cur).groupBy(*keys).agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def _upto(counts: DataFrame, keys: Sequence[str], rows: str, name: str) -> DataFrame:
    """Add ``name``, the running sum of ``rows`` over ``value`` within ``keys``.

    It adds up rows of a part, parts of a cell, and cells, so that no window sorts more than
    one part of a cell of one group.
    """
    k = [column(c) for c in keys]
    by_part = counts.groupBy(*k, "cell", "part").agg(F.sum(rows).alias("_n"))
    line = Window.partitionBy(*k).orderBy("cell", "part")
    starts = by_part.select(*k, "cell", "part", (F.sum("_n").over(line) - F.col("_n")).alias("_start"))
    walk = Window.partitionBy(*k, "cell", "part").orderBy("value")
    ran = counts.withColumn("_ran", F.sum(rows).over(walk))
    return ran.join(starts, [*keys, "cell", "part"]).withColumn(name, F.col("_start") + F.col("_ran")).drop("_start", "_ran")


def _ks_by_group(ref: DataFrame, cur: DataFrame, by: Sequence[str]) -> DataFrame:
    """Largest gap per (``by``, ix), from the values of each group alone.

    Between two neighbouring values of a group its distribution function is flat and that of
    the reference grows, so the largest gap lies at, or just before, a value of the group.
    The reference is looked up once per distinct current value and never copied per group.
    """
    spot = ["ix", "cell", "part", "value"]
    k = [*[column(c) for c in by], F.col("ix")]
    own = cur.groupBy(*k, "cell", "part", "value").agg(F.count(F.lit(1)).alias("c"))
    theirs = ref.groupBy(*spot).agg(F.count(F.lit(1)).alias("r")).withColumn("met", F.lit(False))
    asked = cur.select(*spot).distinct().withColumns({"r": F.lit(0).cast("bigint"), "met": F.lit(True)})
    line = theirs.unionByName(asked).groupBy(*spot).agg(F.sum("r").alias("r"), F.max("met").alias("met"))
    line = _upto(line, ["ix"], "r", "upto_r").filter("met").select(*spot, "r", "upto_r")
    placed = _upto(own, [*by, "ix"], "c", "upto_c").join(line, spot)
    sizes_r = ref.groupBy("ix").agg(F.count(F.lit(1)).alias("nr"))
    sizes_c = own.groupBy(*k).agg(F.sum("c").alias("nc"))
    # One row per column; one row per group and column.
    placed = placed.join(F.broadcast(sizes_r), "ix").join(sizes_c, [*by, "ix"])
    at = _gap(F.col("upto_r"), F.col("upto_c"))
    before = _gap(F.col("upto_r") - F.col("r"), F.col("upto_c") - F.col("c"))
    return placed.groupBy(*k).agg(F.max(F.greatest(at, before)).alias("d"))


def _complete(found: DataFrame, ref_sizes: DataFrame, cur_sizes: DataFrame, groups: DataFrame | None, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``found`` (``by``, ix, d) with a row for every watched column of every group.

    A side without values gives no distance; the counts tell which side it is.
    """
    spark = ref_sizes.sparkSession
    every = F.explode(F.array(*[F.lit(i) for i in range(len(columns))])).alias("ix")
    frame = groups.select(*[column(c) for c in by], every) if groups is not None else spark.range(1).select(every)
    keys = [*by, "ix"]
    none = F.lit(0).cast("bigint")
    # One row per column; the rest has one row per group and column.
    return (
        frame.join(F.broadcast(ref_sizes), "ix", "left")
        .join(cur_sizes, keys, "left")
        .join(found, keys, "left")
        .withColumns({"nr": F.coalesce("nr", none), "nc": F.coalesce("nc", none)})
    )


def ks(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    grid: Grid | None = None,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance and p-value of numeric columns, exact.

    Every watched column has a row (per group): where one side has no value, statistic and
    p-value are NULL and the counts say which. Row counts per cell give the distance at all
    cell borders; only cells that may hold a larger one are looked into: by their parts when
    cells are large, then value by value. With ``by`` see ``_ks_by_group``.
    """
    by = list(by)
    require(reference, columns)
    require(current, [*columns, *by])
    if by:
        current = current.dropna(subset=by)
    if grid is None:
        both = reference.select(*[as_position(reference, c).alias(c) for c in columns]).unionByName(
            current.select(*[as_position(current, c).alias(c) for c in columns])
        )
        grid = build_grid(both, columns)
    k = [*[column(c) for c in by], F.col("ix")]
    ref = long_cells(reference, grid)
    cur = long_cells(current, grid, [column(c) for c in by])
    ref_sizes = ref.groupBy("ix").agg(F.count(F.lit(1)).alias("nr"))
    cur_sizes = cur.groupBy(*k).agg(F.count(F.lit(1)).alias("nc"))
    if by:
        groups = current.select(*[column(c) for c in by]).distinct()
        final = _complete(_ks_by_group(ref, cur, by), ref_sizes, cur_sizes, groups, columns, by)
    else:
        final = _complete(_ks_overall(ref, cur, grid), ref_sizes, cur_sizes, None, columns, by)
    return ks_rows(final, grid, by)


def ks_rows(final: DataFrame, grid: Grid, by: Sequence[str]) -> DataFrame:
    """Result rows from distances (``by``, ix, d) and sizes ``nr`` and ``nc``."""
    p = kolmogorov_p(F.col("d"), F.col("nr"), F.col("nc"))
    return final.select(
        *[column(c) for c in by],
        grid.name_of(F.col("ix")).alias("column"),
        F.lit("ks").alias("test"),
        F.col("d").alias("statistic"),
        F.when((F.col("nr") > 0) & (F.col("nc") > 0), p).alias("p_value"),
        F.col("nr").alias("n_reference"),
        F.col("nc").alias("n_current"),
    )


def _ks_overall(ref: DataFrame, cur: DataFrame, grid: Grid) -> DataFrame:
    """Largest gap per ix where both sides have values."""
    # Reference rows before and up to every cell, empty cells included.
    widest = max(len(e) + 1 for e in grid.edges)
    counted = ref.groupBy("ix", "cell").agg(F.count(F.lit(1)).alias("n"))
    frame = ref.sparkSession.range(len(grid.columns)).select(
        F.col("id").cast("int").alias("ix"),
        F.explode(F.sequence(F.lit(0), F.lit(widest - 1))).alias("cell"),
    )
    up = Window.partitionBy("ix").orderBy("cell")
    rows = F.coalesce("n", F.lit(0))
    ref_line = frame.join(F.broadcast(counted), ["ix", "cell"], "left").select(
        "ix",
        "cell",
        F.sum(rows).over(up).alias("r1"),
        (F.sum(rows).over(up) - rows).alias("r0"),
        F.sum(rows).over(Window.partitionBy("ix")).alias("nr"),
    )
    group = Window.partitionBy("ix")
    cur_line = cur.groupBy("ix", "cell").agg(F.count(F.lit(1)).alias("c")).select(
        "ix",
        "cell",
        F.sum("c").over(group.orderBy("cell")).alias("c1"),
        (F.sum("c").over(group.orderBy("cell")) - F.col("c")).alias("c0"),
        F.sum("c").over(group).alias("nc"),
    )
    # At most a cell per interval and column: small by construction.
    line = cur_line.join(F.broadcast(ref_line.filter("nr > 0")), ["ix", "cell"])
    # All later steps read this small table: compute it once.
    cells = checkpointed(_settled(line, ["ix"]))
    found = [cells.groupBy("ix").agg(F.max("best").alias("d"))]

    # A one-value cell has no inner point.
    single = [(i, grid.one_value_cells(i)) for i in range(len(grid.columns))]
    listed = [f"(ix = {i} AND cell IN ({', '.join(map(str, c))}))" for i, c in single if c]
    inner_point = ~F.expr(" OR ".join(listed)) if listed else F.lit(True)
    opened = cells.filter((F.col("most") > F.col("best")) & inner_point).select(
        "ix", "cell", "r0", "c0", "nr", "nc", "best"
    )
    place = ["cell"]
    if grid.splits > 1:
        by_part = _opened_rows(ref, cur, opened, place, ["part"])
        run = Window.partitionBy("ix", "cell").orderBy("part")
        r, c = F.sum("r").over(run), F.sum("c").over(run)
        parts = by_part.select(
            "ix",
            "cell",
            "part",
            "nr",
            "nc",
            F.col("best").alias("known"),
            (F.col("r0") + r - F.col("r")).alias("r0"),
            (F.col("r0") + r).alias("r1"),
            (F.col("c0") + c - F.col("c")).alias("c0"),
            (F.col("c0") + c).alias("c1"),
        )
        parts = checkpointed(_settled(parts, ["ix"], F.col("known")))
        found.append(parts.groupBy("ix").agg(F.max("best").alias("d")))
        opened = parts.filter(F.col("most") > F.col("best")).select(
            "ix", "cell", "part", "r0", "c0", "nr", "nc", "best"
        )
        place = ["cell", "part"]
    by_value = _opened_rows(ref, cur, opened, place, ["value"])
    walk = Window.partitionBy("ix", *place).orderBy("value")
    gap = _gap(F.col("r0") + F.sum("r").over(walk), F.col("c0") + F.sum("c").over(walk))
    found.append(by_value.select("ix", gap.alias("d")).groupBy("ix").agg(F.max("d").alias("d")))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return best.groupBy("ix").agg(F.max("d").alias("d"))


def _texts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), column(c).cast("string").alias("value")) for c in columns]
    )
    keys = [column(c) for c in by]
    return (
        df.select(*keys, F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy(*keys, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def chi_squared(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Chi-squared homogeneity test of categorical columns.

    With a and b rows of a value, the statistic of the 2 x k table is the sum of
    (a nb - b na)^2 / ((a + b) na nb), in doubles, so that large counts neither overflow nor
    cancel. Values absent from the current side add a nb / na, so only values that occur
    there meet the reference counts, in one equi-join of two pre-aggregated tables. Every
    watched column has a row (per group); without values on one side the statistic is NULL.
    """
    by = list(by)
    require(reference, columns)
    require(current, [*columns, *by])
    if by:
        current = current.dropna(subset=by)
    groups = current.select(*[column(c) for c in by]).distinct() if by else None
    return chi_squared_of_counts(_texts(reference, columns), _texts(current, columns, by), groups, columns, by)


def chi_squared_of_counts(
    ref_counts: DataFrame, cur_counts: DataFrame, groups: DataFrame | None, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """``chi_squared`` from rows per (``by``, ``column``, ``value``) of both sides."""
    places = {c: i for i, c in enumerate(columns)}
    ix = F.element_at(F.create_map(*[F.lit(x) for pair in places.items() for x in pair]), F.col("column")).alias("ix")
    k = [*[column(c) for c in by], F.col("ix")]
    ref = ref_counts.select(ix, "value", F.col("n").alias("a"))
    cur = cur_counts.select(*k[:-1], ix, "value", F.col("n").alias("b"))
    ref_sizes = ref.groupBy("ix").agg(F.sum("a").alias("nr"), F.count(F.lit(1)).alias("ka"))
    cur_sizes = cur.groupBy(*k).agg(F.sum("b").alias("nc"))
    # One row of totals per column, and per group and column.
    met = cur.join(ref, ["ix", "value"], "left").join(F.broadcast(ref_sizes.select("ix", "nr")), "ix").join(cur_sizes, [*by, "ix"])
    a, b, na, nb = (F.col(c).cast("double") for c in ("a", "b", "nr", "nc"))
    a = F.coalesce(a, F.lit(0.0))
    term = (a * nb - b * na) * (a * nb - b * na) / ((a + b) * na * nb)
    found = met.groupBy(*k).agg(
        F.sum(term).alias("shared"), F.sum(a).alias("met"), F.count_if(F.col("a").isNull()).alias("fresh")
    )
    rows = _complete(found, ref_sizes, cur_sizes, groups, columns, by)
    unmet = (na - F.col("met")) * nb / na
    full = (F.col("nr") > 0) & (F.col("nc") > 0)
    scored = rows.select(
        *[column(c) for c in by],
        F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("ix") + 1).alias("column"),
        F.lit("chi2").alias("test"),
        F.when(full, F.col("shared") + unmet).alias("statistic"),
        F.when(full, F.col("ka") + F.col("fresh") - 1).cast("bigint").alias("freedom"),
        F.col("nr").alias("n_reference"),
        F.col("nc").alias("n_current"),
    )
    return scored.select(
        *[column(c) for c in by],
        "column",
        "test",
        "statistic",
        chi_squared_p(F.col("statistic"), F.col("freedom")).alias("p_value"),
        "n_reference",
        "n_current",
    )


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    by: Sequence[str] = (),
    alpha: float = ALPHA,
) -> DataFrame:
    """Drift score and verdict per column: KS for numbers, chi-squared for categories.

    ``status`` says what the verdict rests on: ``tested``, or which sides have no value. A
    column with values on one side only has drifted.
    """
    parts = []
    if numeric:
        parts.append(ks(reference, current, numeric, by))
    if categorical:
        parts.append(chi_squared(reference, current, categorical, by))
    if not parts:
        raise ValueError("no column to compare")
    return judged(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), alpha)


def judged(rows: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add ``drifted`` and ``status`` to rows of tests."""
    some_ref, some_cur = F.col("n_reference") > 0, F.col("n_current") > 0
    status = (
        F.when(some_ref & some_cur, "tested")
        .when(some_ref, "no current values")
        .when(some_cur, "no reference values")
        .otherwise("no values")
    )
    drifted = F.coalesce(F.col("p_value") < alpha, some_ref != some_cur)
    return rows.withColumns({"drifted": drifted, "status": status})


def alert_tier(share: Column) -> Column:
    """``critical`` above 0.30 of columns drifted, ``warning`` above 0.15, else ``ok``."""
    return F.when(share > 0.30, "critical").when(share > 0.15, "warning").otherwise("ok")


def drift_summary(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Dataset verdict from per-column rows: any, how many and what share drifted."""
    require(rows, ["drifted", *by])
    summary = rows.groupBy(*[column(c) for c in by]).agg(
        F.count_if("drifted").alias("number_of_drifted_columns"),
        F.count(F.lit(1)).alias("number_of_columns"),
    )
    share = F.col("number_of_drifted_columns") / F.col("number_of_columns")
    return summary.select(
        *[column(c) for c in by],
        (F.col("number_of_drifted_columns") > 0).alias("dataset_drift_detected"),
        "number_of_drifted_columns",
        "number_of_columns",
        share.alias("share_of_drifted_columns"),
        alert_tier(share).alias("tier"),
    )


def drift_history(
    reference: DataFrame,
    current: DataFrame,
    period: str | Column,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    alpha: float = ALPHA,
) -> DataFrame:
    """Summary per period, or per labelled dataset, against one reference."""
    name = column(period) if isinstance(period, str) else period
    labelled = current.withColumn("period", name)
    rows = column_drift(reference, labelled, numeric, categorical, ["period"], alpha)
    return drift_summary(rows, ["period"])


# --- stability index against a stored profile -----------------------------------------


@dataclass(frozen=True)
class Profile:
    """What a monitor keeps of the reference: bucket edges and rows per bucket."""

    columns: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    expected: tuple[tuple[int, ...], ...]

    def as_dict(self) -> dict:
        return asdict(self)

    @staticmethod
    def from_dict(stored: dict) -> "Profile":
        return Profile(
            tuple(stored["columns"]),
            tuple(tuple(e) for e in stored["edges"]),
            tuple(tuple(e) for e in stored["expected"]),
        )


def bucket_of(value: Column, edges: Sequence[float]) -> Column:
    """Number 1.. of the bucket between edges, last edge closed; NULL outside."""
    if not edges:
        return F.when(value.isNull(), F.lit(None).cast("int"))
    steps = [F.when(value >= F.lit(float(e)), 1).otherwise(0) for e in edges[1:-1]]
    place = F.lit(1)
    for step in steps:
        place = place + step
    return F.when((value >= F.lit(float(edges[0]))) & (value <= F.lit(float(edges[-1]))), place)


def _bucket_counts(
    df: DataFrame, profile_edges: Sequence[Sequence[float]], columns: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Rows per bucket; bucket 0 holds the values outside all buckets."""
    pairs = []
    for i, c in enumerate(columns):
        value = nan_to_null(column(c).cast("double"))
        bucket = F.when(value.isNotNull(), F.coalesce(bucket_of(value, profile_edges[i]), F.lit(0)))
        pairs.append(F.struct(F.lit(i).alias("ix"), bucket.alias("bucket")))
    keys = [column(c) for c in by]
    return (
        df.select(*keys, F.inline(F.array(*pairs)))
        .filter(F.col("bucket").isNotNull())
        .groupBy(*keys, "ix", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def build_profile(reference: DataFrame, columns: Sequence[str], buckets: int = 10) -> Profile:
    """Quantile edges of the reference and its rows per bucket: small, fixed size.

    A constant column has one bucket, its value; a column without values has none.
    """
    shares = {f"q{i}": i / buckets for i in range(buckets + 1)}
    found = quantile_values(reference, columns, shares)
    edges = []
    for c in columns:
        own = sorted({v for v in found[c].values() if v is not None})
        edges.append(own * 2 if len(own) == 1 else own)
    counts = _bucket_counts(reference, edges, columns, []).collect()
    seen = {(r["ix"], r["bucket"]): r["n"] for r in counts}
    expected = [tuple(seen.get((i, b), 0) for b in range(1, len(e))) for i, e in enumerate(edges)]
    return Profile(tuple(columns), tuple(map(tuple, edges)), tuple(expected))


def psi_against(profile: Profile, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Population stability index per (``by``, column) against a stored profile.

    Values outside the reference range are left out of the index and counted in
    ``n_outside``; an empty bucket counts as 1e-6 rows. Every profile column has a row (per
    group): without any value in range the index is infinite if there are values outside,
    else NULL. A reference without values gives NULL.
    Output: ``by``, ``column``, ``psi``, ``n_reference``, ``n_current`` (rows in range),
    ``n_outside``.
    """
    by = list(by)
    require(current, [*profile.columns, *by])
    if by:
        current = current.dropna(subset=by)
    counts = bucket_counts(profile, current, by)
    groups = current.select(*[column(c) for c in by]).distinct() if by else current.sparkSession.range(1)
    return psi_of_counts(profile, counts, groups, by)


def bucket_counts(profile: Profile, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``n`` per (``by``, ix, bucket) of a profile; counts of parts of a table add up."""
    return _bucket_counts(current, profile.edges, profile.columns, list(by))


def psi_of_counts(profile: Profile, counts: DataFrame, groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``psi_against`` from ``bucket_counts``, for the ``by`` values in ``groups``."""
    by = list(by)
    keys = [*[column(c) for c in by], F.col("ix")]
    inside = F.col("bucket") > 0
    # At most one entry per bucket and group.
    seen = counts.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.when(inside, F.struct("bucket", "n")))).alias("seen"),
        F.sum(F.when(inside, F.col("n"))).alias("nc"),
        F.sum(F.when(~inside, F.col("n"))).alias("outside"),
    )
    every = F.explode(F.array(*[F.lit(i) for i in range(len(profile.columns))])).alias("ix")
    none = F.lit(0).cast("bigint")
    rows = groups.select(*keys[:-1], every).join(seen, [*by, "ix"], "left").withColumns(
        {"nc": F.coalesce("nc", none), "outside": F.coalesce("outside", none)}
    )
    wanted = F.element_at(
        F.array(*[F.expr(doubles(float(n) for n in e)) if e else F.expr("CAST(array() AS ARRAY<DOUBLE>)") for e in profile.expected]),
        F.col("ix") + 1,
    )
    floor = F.lit(EMPTY_BUCKET_ROWS)
    total = F.aggregate("wanted", F.lit(0.0), lambda acc, n: acc + n)

    def share(n: Column, size: Column) -> Column:
        return F.when(n == 0, floor).otherwise(n.cast("double")) / size

    in_range = F.nullif(F.col("nc"), none)
    terms = F.transform(
        "wanted",
        lambda n, i: psi_term(
            share(n, F.col("nr")),
            share(F.coalesce(F.try_element_at("seen", i + 1), F.lit(0)), in_range),
        ),
    )
    index = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    unmet = F.when((F.col("nc") == 0) & (F.col("outside") > 0), F.lit(float("inf")))
    scored = rows.withColumn("wanted", wanted).withColumn("nr", total)
    return scored.select(
        *keys[:-1],
        F.element_at(F.array(*[F.lit(c) for c in profile.columns]), F.col("ix") + 1).alias("column"),
        F.when(F.col("nr") > 0, F.coalesce(unmet, index)).alias("psi"),
        F.col("nr").cast("bigint").alias("n_reference"),
        F.col("nc").alias("n_current"),
        F.col("outside").alias("n_outside"),
    )


def psi(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    buckets: int = 10,
    by: Sequence[str] = (),
) -> DataFrame:
    """Population stability index with quantile buckets of the reference."""
    return psi_against(build_profile(reference, columns, buckets), current, by)


def monitored_columns(reference: DataFrame, target: str, prediction: str, time: str) -> tuple[list[str], list[str]]:
    """Columns a monitor watches: all but target, prediction and time, by type."""
    return classify(reference, [target, prediction, time])
