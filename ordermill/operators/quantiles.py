"""Discrete quantiles of whole columns, for use as thresholds."""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.operators.sketches import SKETCH_ACCURACY, merged_sketches, sketched_quantile

VALUE = "decimal(20,2)"
MOST, LIMIT = "999999999999999999.99", 999_999_999_999_999_872.0  # the largest amount, and the largest double below it


def quantiles(
    df: DataFrame,
    wanted: Mapping[str, tuple[str, str]],
    method: str = "exact",
    accuracy: int | None = None,
    sketches: DataFrame | None = None,
) -> Column:
    """A scalar struct with one field per entry of `wanted`: name -> (column, fraction as text).

    Quantile p of n values is the ceil(p * n)-th smallest. Columns are integers or decimals with
    at most two places; NULLs are left out; without values the field is NULL.

    `approx` returns the sketch's own answer, with a rank error up to n / accuracy (10,000 if not
    given). `exact` takes one more pass and needs only a coarse sketch (4,000), which matters because
    every task's sketch goes to the one that merges them.

    `sketches` (measure, sketch) are stored ones of the same rows, any number per column: `operators.sketches` makes and merges them. `approx` then
    reads them alone; `exact` takes its brackets from them instead of a pass over `df`, and raises an error, rather than give a wrong value, should a
    quantile lie outside its bracket, as with sketches of other rows.
    """
    if sketches is not None:
        columns = dict.fromkeys(column for column, _ in wanted.values())
        merged = merged_sketches(sketches, columns)
        if method == "approx":
            types = dict(df.dtypes)
            return merged.select(F.struct(*[sketched_quantile(c, p).cast(types[c]).alias(name) for name, (c, p) in wanted.items()])).scalar()
        if method == "exact":
            return _exact(df, wanted, SKETCH_ACCURACY, merged)
    if method == "exact":
        return _exact(df, wanted, accuracy or 4_000)
    if method == "approx":
        accuracy = accuracy or 10_000
        fields = [
            F.percentile_approx(column, float(Fraction(p)), accuracy).alias(name)
            for name, (column, p) in wanted.items()
        ]
        return df.agg(F.struct(*fields).alias("q")).scalar()
    raise ValueError(f"method must be 'exact' or 'approx', not {method!r}")


def _exact(df: DataFrame, wanted: Mapping[str, tuple[str, str]], accuracy: int, merged: DataFrame | None = None) -> Column:
    """Bracket each quantile with a sketch, then count exactly, keeping only in-bracket values apart.

    Every row falls into a slot of its column: a bracket, where values are counted one by one, or a gap between brackets, which is
    one count. A rank is the running count inside a bracket plus the totals of the slots below, so a task of
    the last window holds one bracket: the distinct values between two ranks some 10 / accuracy of all rows apart.

    The sketch works on doubles; its bounds are widened by more than a double's spacing at their size, so they bracket
    the stored decimals whatever their size.
    """
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    fractions = {c: sorted({Fraction(p) for col, p in wanted.values() if col == c}) for c in columns}
    margin = Fraction(4, accuracy)
    ends = {c: [end for p in fractions[c] for end in (max(p - margin, Fraction(0)), min(p + margin, Fraction(1)))] for c in columns}

    # Expressions are written as SQL text: a report builds them anew each time, and text is one call instead of one per operation.
    def bounds(column: str) -> str:
        places = ", ".join(f"{float(x)!r}D" for x in ends[column])
        found = f"percentile_approx(CAST(`{column}` AS double), array({places}), {accuracy})"
        wide = f"x + if(k % 2 = 1, 1, -1) * (abs(x) * {2.0**-50!r}D + 0.01D)"
        fitted = f"CASE WHEN {wide} >= {LIMIT}D THEN CAST({MOST} AS {VALUE}) WHEN {wide} <= -{LIMIT}D THEN -CAST({MOST} AS {VALUE}) ELSE CAST({wide} AS {VALUE}) END"
        return f"'{column}', transform({found}, (x, k) -> {fitted})"

    if merged is None:
        sketch = df.agg(F.expr(f"named_struct({', '.join(map(bounds, columns))})").alias("s")).scalar()
    else:
        nothing = F.lit(0).cast(VALUE)
        stored = [F.array(*[F.coalesce(sketched_quantile(c, end), nothing) for end in ends[c]]).alias(c) for c in columns]
        sketch = merged.select(F.struct(*stored).alias("s")).scalar()

    def entry(column: str) -> str:
        slot = _slot(f"CAST(`{column}` AS {VALUE})", f"s.`{column}`", len(fractions[column]))
        inside = f"if({slot} % 2 = 1, CAST(`{column}` AS {VALUE}), NULL)"
        return f"named_struct('measure', '{column}', 'slot', {slot}, 'value', {inside})"

    frequency = (
        df.select(*columns)
        .withColumn("s", sketch)
        .selectExpr(f"inline(array({', '.join(map(entry, columns))}))")
        .filter("slot IS NOT NULL")
        .groupBy("measure", "slot", "value")
        .agg(F.count("*").alias("n"))
    )
    slots = frequency.groupBy("measure", "slot").agg(F.sum("n").alias("n"))
    totals = slots.agg(F.expr("collect_list(struct(measure, slot, n))")).scalar()  # a few slots per column
    # All rows of the column, and those in slots below.
    rows = "aggregate(filter(t, e -> e.measure = measure {}), 0L, (total, e) -> total + e.n)"
    counted = (
        frequency.filter("slot % 2 = 1")
        .withColumn("running", F.expr("sum(n) OVER (PARTITION BY measure, slot ORDER BY value ROWS UNBOUNDED PRECEDING)"))
        .withColumn("t", totals)
        .selectExpr("measure", "value", "n", f"running + {rows.format('AND e.slot < slot')} AS seen", f"{rows.format('')} AS total")
    )

    def pick(column: str, p: Fraction) -> Column:
        def rank(total: str) -> str:
            return f"greatest(({total} * {p.numerator}L + {p.denominator - 1}L) div {p.denominator}L, 1L)"

        mine = f"measure = '{column}'"
        reached = f"{mine} AND seen >= {rank('total')}"
        found = F.expr(f"min(if({reached}, value, NULL))")
        if merged is None:
            return found
        # Stored sketches must fit: the rank lies behind the values below the bracket. A column without rows has no quantile.
        fits = F.expr(f"min(if({reached}, seen - n, NULL)) < {rank(f'max(if({mine}, total, NULL))')}")
        empty = slots.agg(F.count_if(F.col("measure") == column)).scalar() == 0
        wrong = F.raise_error(F.lit(f"the stored sketches of {column} do not fit its rows")).cast(VALUE)
        return F.when(found.isNotNull() & fits, found).when(empty, F.lit(None)).otherwise(wrong)

    types = dict(df.dtypes)
    picked = [pick(c, Fraction(p)).cast(types[c]).alias(name) for name, (c, p) in wanted.items()]
    return counted.agg(F.struct(*picked).alias("q")).scalar()


def _slot(value: str, bounds: str, brackets: int) -> str:
    """2 i + 1 in bracket i, 2 i in the gap below it; slots are in the order of their values."""
    cases = [f"WHEN {value} < {bounds}[0] THEN 0"]
    for i in range(brackets):
        cases.append(f"WHEN {value} <= {bounds}[{2 * i + 1}] THEN {2 * i + 1}")
        if i + 1 < brackets:
            cases.append(f"WHEN {value} < {bounds}[{2 * i + 2}] THEN {2 * i + 2}")
    return f"CASE {' '.join(cases)} WHEN {value} > {bounds}[{2 * brackets - 1}] THEN {2 * brackets} END"
