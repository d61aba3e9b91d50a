"""Validation and cleaning (V1-V14), generic over a :class:`TableSpec`.

All checks are column expressions; the full report (ranges, domains, missing
values, duplicates of whole rows and of keys) is ONE scan with one narrow aggregate,
in which rows stand by 128-bit digests (map-side partial counts, so a hot key
costs one row per task before the shuffle).
"""

from __future__ import annotations

from typing import Optional, Sequence

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from saferow.functions.exprs import numeric_columns, safe_div
from saferow.spec import FOOD_SAFETY, TableSpec


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


# ------------------------------------------------------------------ V1 schema
def schema_check(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> DataFrame:
    """V1: one row per missing (error) or extra (warning) column.

    Works on the column list only; no data is read.  Columns: kind, column.
    """
    present = set(df.columns)
    required = list(spec.required_columns)
    extra_ok = {spec.key} if spec.key else set()
    rows = [("missing", c) for c in required if c not in present]
    rows += [("extra", c) for c in df.columns if c not in required and c not in extra_ok]
    schema = "kind string, column_name string"
    return df.sparkSession.createDataFrame(rows, schema)


def schema_is_valid(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> bool:
    return all(c in df.columns for c in spec.required_columns)


# ------------------------------------------------------------------ V2/V3 ranges
def _out_of_range(c: str, lo: float, hi: float | None) -> Column:
    cond = F.col(c) < F.lit(lo)
    if hi is not None:
        cond = cond | (F.col(c) > F.lit(hi))
    return F.coalesce(cond, F.lit(False))  # missing is never a violation


def range_flags(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> DataFrame:
    """V2: per-row out-of-range flags (bounds inclusive), one boolean column per
    checked column that is present, plus the key if the table has one."""
    keep = [spec.key] if spec.key and spec.key in df.columns else []
    flags = [_out_of_range(c, lo, hi).alias(c)
             for c, (lo, hi) in spec.numeric_ranges.items() if c in df.columns]
    return df.select(*keep, *flags)


def _unpivot(one_row: DataFrame, names: list[str], value_cols: dict[str, str],
             name_col: str = "column_name") -> DataFrame:
    """Turn ``<metric>__<name>`` columns of a one-row frame into a long table."""
    if not names:
        fields = ", ".join(f"CAST(NULL AS BIGINT) AS {v}" for v in value_cols)
        return one_row.sparkSession.sql(f"SELECT CAST(NULL AS STRING) AS {name_col}, {fields}").limit(0)
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts.extend(f"`{m}__{n}`" for m in value_cols)
    expr = f"stack({len(names)}, {', '.join(parts)}) as ({name_col}, {', '.join(value_cols)})"
    return one_row.selectExpr(expr)


def range_violations(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> DataFrame:
    """V3: violation count per checked column (column, violations) and the
    offending-column list is the rows with violations > 0."""
    cols = [c for c in spec.numeric_ranges if c in df.columns]
    aggs = [F.sum(_out_of_range(c, *spec.numeric_ranges[c]).cast("long")).alias(f"violations__{c}")
            for c in cols]
    one = df.agg(*aggs) if aggs else df.limit(0)
    return _unpivot(one, cols, {"violations": "long"}).select(
        "column_name", F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations"))


# ------------------------------------------------------------------ V4 domains
def _invalid_value(c: str, domain: tuple[str, ...]) -> Column:
    return F.col(c).isNotNull() & ~F.lower(F.col(c)).isin(*domain)


def invalid_categories(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> DataFrame:
    """V4: invalid values per categorical column, compared case-insensitively;
    each distinct offending value in its original case with its row count.

    Columns: column, value, n.  One pass: the values of all checked columns are
    exploded into (column, value) pairs of invalid cells only, then counted.
    """
    cols = [c for c in spec.categorical_domains if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n long")
    pairs = F.array(*[
        F.when(_invalid_value(c, spec.categorical_domains[c]),
               F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c in cols
    ])
    return (df.select(F.explode(F.array_compact(pairs)).alias("kv"))
            .groupBy(F.col("kv.column_name").alias("column_name"), F.col("kv.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def invalid_category_counts(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> DataFrame:
    """V4 counts: (column, invalid) for every checked categorical column."""
    cols = [c for c in spec.categorical_domains if c in df.columns]
    aggs = [F.sum(_invalid_value(c, spec.categorical_domains[c]).cast("long")).alias(f"invalid__{c}")
            for c in cols]
    one = df.agg(*aggs) if aggs else df.limit(0)
    return _unpivot(one, cols, {"invalid": "long"}).select(
        "column_name", F.coalesce(F.col("invalid"), F.lit(0)).cast("long").alias("invalid"))


# ------------------------------------------------------------------ V5 missing
def missing_values(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """V5: per column missing_count, missing_ratio, acceptable (ratio <= threshold);
    ratio 0 on an empty table.  One aggregate for all columns."""
    cols = df.columns
    aggs = []
    for c in cols:
        miss = F.sum(F.col(_quoted(c)).isNull().cast("long"))
        aggs.append(F.coalesce(miss, F.lit(0)).cast("long").alias(f"missing__{c}"))
        aggs.append(F.coalesce(safe_div(miss, F.count(F.lit(1))), F.lit(0.0)).alias(f"ratio__{c}"))
    one = df.agg(*aggs)
    long = _unpivot(one, cols, {"missing": "long", "ratio": "double"})
    return long.select("column_name", F.col("missing").alias("missing_count"),
                       F.col("ratio").alias("missing_ratio"),
                       (F.col("ratio") <= F.lit(threshold)).alias("acceptable"))


# ------------------------------------------------------------------ V6/V7 duplicates
#: Seeds that make the two halves of a digest independent of each other.
_DIGEST_SEEDS = (0x5EED, 0xD16E57)


def digest_columns(cols: Sequence[str]) -> list[str]:
    """SQL of 128 bits that stand for the values of ``cols``, as two longs; rows agree in them
    if they agree in every column, NULL equal to NULL, NaN to NaN and -0.0 to 0.0.

    Which columns are NULL is hashed with the values, since the hash function passes
    over NULL.  Two of 10**12 different rows share a digest with a chance of 1e-15.
    """
    names = [_quoted(c) for c in cols]
    nulls = ", ".join(f"isnull({c})" for c in names)
    return [f"xxhash64({seed}, {nulls}, {', '.join(names)})" for seed in _DIGEST_SEEDS]


def duplicate_count(df: DataFrame, subset: list[str] | None = None, compare: bool = False) -> DataFrame:
    """V6/V7: rows minus distinct rows over ``subset`` (all columns if None);
    NULL equals NULL.  Output: one row ``duplicates``.

    A ``subset`` is grouped by its values.  Whole rows are grouped by their digests, so
    17 columns cost a shuffle of two longs; with ``compare`` the rows whose digest occurs
    twice or more are also compared column by column (a second scan; only they move).
    """
    one = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates")
    if subset:
        return df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n")).agg(one)
    high, low = (F.expr(e) for e in digest_columns(df.columns))
    groups = df.select(high.alias("_h"), low.alias("_l")).groupBy("_h", "_l").agg(F.count(F.lit(1)).alias("_n"))
    if not compare:
        return groups.agg(one)
    twice = groups.where("_n > 1").select("_h", "_l")
    rows = df.withColumns({"_h": high, "_l": low}).join(twice, ["_h", "_l"], "left_semi")
    return rows.groupBy("_h", "_l", *map(_quoted, df.columns)).agg(F.count(F.lit(1)).alias("_n")).agg(one)


# ------------------------------------------------------------------ V8 report
@dataclass
class ValidationReport:
    """V8: the combined report as tidy DataFrames plus a one-row verdict."""

    schema: DataFrame
    ranges: DataFrame
    categories: DataFrame
    invalid_values: DataFrame
    missing: DataFrame
    duplicates: DataFrame
    long: DataFrame
    verdict: DataFrame


#: Checks whose outcomes are counted together: a row's outcomes are the bits of one number,
#: so a group of checks has at most 2**16 different rows.
_BITS = 16


def counted_checks(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> DataFrame:
    """Every count of the report from ONE scan, as one row of longs: rows,
    ``range_violations__<c>``, ``invalid_categories__<c>``, ``missing__<c>``,
    ``duplicates__*`` and ``duplicates__<key>``.

    Each row is expanded into a few narrow items (kind, a, b): its digest, the digest of
    each duplicate key, and the outcomes of its checks as bits, 16 checks a number.  One
    aggregate counts equal items.  Its partial form leaves at most 65,536 rows a task
    of each group of checks, so only digests are shuffled in numbers that grow.
    """
    checks = []  # (name, SQL of the violation)
    for c, (lo, hi) in spec.numeric_ranges.items():
        if c in df.columns:
            above = "" if hi is None else f" OR {_quoted(c)} > {hi!r}D"
            checks.append((f"range_violations__{c}", f"{_quoted(c)} < {lo!r}D{above}"))
    for c, domain in spec.categorical_domains.items():
        if c in df.columns:
            known = ", ".join(map(_text, domain))
            checks.append((f"invalid_categories__{c}", f"lower({_quoted(c)}) NOT IN ({known})"))
    checks += [(f"missing__{c}", f"isnull({_quoted(c)})") for c in df.columns]
    sets = [("*", df.columns)] + [(k, [k]) for k in spec.duplicate_keys if k in df.columns]
    items = []
    for i, (_, cols) in enumerate(sets):
        items += [f"{i}", *digest_columns(cols)]
    for j in range(0, len(checks), _BITS):  # a comparison with NULL is no violation
        bits = [f"if({cond}, {1 << k}L, 0L)" for k, (_, cond) in enumerate(checks[j:j + _BITS])]
        items += [f"{len(sets) + j // _BITS}", " + ".join(bits), "0L"]
    narrow = df.selectExpr(*[f"{e} AS _i{n}" for n, e in enumerate(items)])
    each = narrow.selectExpr(f"stack({len(items) // 3}, {', '.join(narrow.columns)}) AS (kind, a, b)")
    same = each.groupBy("kind", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    kinds = same.groupBy("kind", F.expr(f"if(kind >= {len(sets)}, a, NULL)").alias("bits")) \
        .agg(F.sum("n").alias("n"), F.expr("sum(n - 1)").alias("again"))
    total = "CAST(coalesce(sum(if({}, {}, 0L)), 0L) AS BIGINT)"
    out = [(total.format("kind = 0", "n"), "rows")]
    out += [(total.format(f"kind = {i}", "again"), f"duplicates__{name}") for i, (name, _) in enumerate(sets)]
    out += [(total.format(f"kind = {len(sets) + j // _BITS} AND (bits & {1 << j % _BITS}L) <> 0", "n"), name)
            for j, (name, _) in enumerate(checks)]
    return kinds.selectExpr(*[f"{e} AS {_quoted(name)}" for e, name in out])


def _ratio(name: str) -> str:
    return f"if(rows = 0, 0D, CAST({_quoted(name)} AS DOUBLE) / rows)"


def _text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _long_report(counts: DataFrame) -> DataFrame:
    """The one row of :func:`counted_checks` as (check_name, column_name, metric, value)."""
    parts = []
    for name in counts.columns:
        check, _, column = name.partition("__")
        parts.append(f"{_text(check)}, {_text(column or '*')}, 'count', CAST({_quoted(name)} AS DOUBLE)")
        if check == "missing":
            parts.append(f"{_text(check)}, {_text(column)}, 'ratio', {_ratio(name)}")
    return counts.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) AS (check_name, column_name, metric, value)")


def fused_checks(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> DataFrame:
    """Ranges, domains, missing values and duplicates of every column in one scan, as a
    long table (check_name, column_name, metric, value)."""
    return _long_report(counted_checks(df, spec))


def validate_full(df: DataFrame, spec: TableSpec = FOOD_SAFETY, strict: bool = False,
                  missing_threshold: float | None = None) -> ValidationReport:
    """V8: V1-V7 together, from one scan of the table (:func:`counted_checks`).

    Long table columns: check_name, column_name, metric, value (double).  The verdict row
    holds is_valid, schema_valid, range_valid, categorical_valid,
    missing_acceptable, n_samples, n_features, total_duplicates.  Schema errors
    make the verdict false; with ``strict`` also range and domain failures;
    missing excess and duplicates never do.  Schema errors are kept in the long
    table alongside the others (the reference loses them when it rebuilds its
    error list).  The other tables are computed when they are read, by scans of their own.
    """
    thr = spec.missing_threshold if missing_threshold is None else missing_threshold
    schema = schema_check(df, spec)
    counts = counted_checks(df, spec)
    schema_long = schema.select(F.concat(F.lit("schema_"), F.col("kind")).alias("check_name"), "column_name",
                                F.lit("flag").alias("metric"), F.lit(1.0).alias("value"))
    checks = _long_report(counts)
    dups = checks.where("check_name = 'duplicates'") \
        .select(F.col("value").cast("long").alias("duplicates"), "column_name")

    def none_of(check: str) -> str:
        return " + ".join(["0L"] + [_quoted(c) for c in counts.columns if c.startswith(check + "__")]) + " = 0"

    schema_valid = schema_is_valid(df, spec)
    valid = str(schema_valid).lower()
    strictly = f" AND {none_of('range_violations')} AND {none_of('invalid_categories')}" if strict else ""
    acceptable = " AND ".join(["true"] + [f"{_ratio(f'missing__{c}')} <= {float(thr)!r}D" for c in df.columns])
    verdict = counts.selectExpr(
        f"{valid}{strictly} AS is_valid", f"{valid} AS schema_valid", f"{none_of('range_violations')} AS range_valid",
        f"{none_of('invalid_categories')} AS categorical_valid", f"{acceptable} AS missing_acceptable",
        "rows AS n_samples", f"{len(df.columns)} AS n_features", "`duplicates__*` AS total_duplicates")
    return ValidationReport(schema=schema, ranges=range_violations(df, spec),
                            categories=invalid_category_counts(df, spec),
                            invalid_values=invalid_categories(df, spec),
                            missing=missing_values(df, thr), duplicates=dups,
                            long=checks.unionByName(schema_long), verdict=verdict)


# ------------------------------------------------------------------ V9 row schema
def row_errors(spec: TableSpec = FOOD_SAFETY, columns: Optional[Sequence[str]] = None) -> Column:
    """V9: per-row list of error codes ``<column>:<kind>`` in column order.

    Every field is required and non-null; ranges inclusive; enum values are
    case-sensitive; integer columns accept whole numbers only.  ``columns`` limits
    the check (data to be scored has no target).
    """
    codes = []
    for c in spec.required_columns if columns is None else columns:
        codes.append(F.when(F.col(c).isNull(), F.lit(f"{c}:missing")))
        if c in spec.numeric_ranges:
            lo, hi = spec.numeric_ranges[c]
            bad = F.col(c) < F.lit(lo)
            if hi is not None:
                bad = bad | (F.col(c) > F.lit(hi))
            codes.append(F.when(bad, F.lit(f"{c}:range")))
        if c in spec.integer_columns:
            codes.append(F.when(F.col(c).cast("double") != F.floor(F.col(c).cast("double")),
                                F.lit(f"{c}:not_integer")))
        if c in spec.categorical_domains:
            codes.append(F.when(~F.col(c).isin(*spec.categorical_domains[c]), F.lit(f"{c}:domain")))
    return F.array_compact(F.array(*codes))


def with_row_errors(df: DataFrame, spec: TableSpec = FOOD_SAFETY, out: str = "errors") -> DataFrame:
    return df.withColumn(out, row_errors(spec))


def quarantine(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> tuple[DataFrame, DataFrame]:
    """Split into (accepted, quarantined-with-errors) by the row check."""
    checked = with_row_errors(df, spec)
    accepted = checked.filter(F.size("errors") == 0).drop("errors")
    rejected = checked.filter(F.size("errors") > 0)
    return accepted, rejected


# ------------------------------------------------------------------ V10-V14 cleaning
def null_out_of_range(df: DataFrame, spec: TableSpec = FOOD_SAFETY) -> DataFrame:
    """Out-of-range cells become NULL (rows are kept)."""
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in spec.numeric_ranges:
            out.append(F.when(_out_of_range(c, *spec.numeric_ranges[c]), F.lit(None).cast(f.dataType))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fill_statistics(df: DataFrame, cols: list[str], how: str, approx: bool = False) -> dict:
    """Median (exact, interpolated) or mean of each column.

    Means are one aggregate.  Exact medians route each column by its distinct
    count (see :mod:`saferow.operators.quantiles`) so memory stays bounded at
    any scale; ``approx=True`` uses ``percentile_approx`` instead.
    """
    if not cols:
        return {}
    if how == "median":
        if approx:
            row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 100000).alias(c)
                           for c in cols]).first()
            return {c: row[c] for c in cols}
        from saferow.operators.quantiles import exact_medians
        return exact_medians(df, cols)
    if how == "mean":
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    raise ValueError(f"unknown statistic {how}")


def clean(df: DataFrame, spec: TableSpec = FOOD_SAFETY, remove_outliers: bool = True,
          fill_missing: str = "median", approx: bool = False) -> DataFrame:
    """Null out-of-range cells, then fill every numeric column (listed or
    not) with its median/mean computed after the nulling, or drop rows with a
    missing numeric.  Any other mode leaves missing values; categorical columns
    are never changed.  Filled integer columns become double (a median can be
    x.5).
    """
    out = null_out_of_range(df, spec) if remove_outliers else df
    num = [c for c in numeric_columns(out) if c != spec.key]  # the row key is not a measurement
    if fill_missing in ("median", "mean"):
        stats = fill_statistics(out, num, fill_missing, approx)
        cols = []
        for f in out.schema.fields:
            if f.name in stats:
                base = F.col(f.name).cast("double")
                val = stats[f.name]
                cols.append((F.coalesce(base, F.lit(val)) if val is not None else base).alias(f.name))
            else:
                cols.append(F.col(f.name))
        return out.select(*cols)
    if fill_missing == "drop":
        return out.dropna(subset=num)
    return out
