"""Windows from one row per customer: arrays of running sums, of which a window is the difference of two entries.

Monthly rows are dealt out by customer once. Running sums over the months of a customer become an array of entries, so that the
sums of any window are the last entry up to its end less the last one before its start; counts, means,
slopes (running moments) and deviations (running moments about the customer's first value) follow from them. Medians, least
and greatest values come from slices of the months that have rows. Windows that hold the same months share these measures: they
are taken once, and a window's row is made behind the last aggregation; no copy of a monthly row is shuffled or aggregated.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Measures of a month that are summed over windows, and the type of their sums.
LONG_SUMS = ("item_sum", "revenue_sum", "complaint_sum", "months_with_complaint", *[f"ser_{s}" for s in "cemprulq"])
DOUBLE_SUMS = ("weight_sum", "delay_sum", "delay_day_sum", "refund_sum", "noaccepted_sum", "lost_sum", "nodone_sum", "intra_prov_sum", "intl_sum", "order_score_avg", "satisfaction_avg", "avg_lastday")
#: Those that are counts of a month's rows and so never null.
COUNTS = ("months_with_complaint", *[f"ser_{s}" for s in "cemprulq"])
#: Those with deviations, medians with least and greatest values, and slopes.
SPREAD = ("item_sum", "revenue_sum", "complaint_sum", "weight_sum", "order_score_avg", "satisfaction_avg")
MEDIANS = ("item_sum", "revenue_sum", "complaint_sum")
SLOPES = {"item_slope": "item_sum", "revenue_slope": "revenue_sum", "satisfy_slope": "satisfaction_avg", "complaint_slope": "complaint_sum"}
#: Names of the extreme months, the measure, and what a missing value counts as.
EXTREMES = {"item": ("item_sum", None), "revenue": ("revenue_sum", None), "complaint": ("complaint_sum", -1), "order": ("order_score_avg", -1.0), "satisfaction": ("satisfaction_avg", -1.0)}


def month_number(date: Column | str, start: str) -> Column:
    """Months from the month of ``start`` to that of ``date``."""
    d, s = F.col(date) if isinstance(date, str) else date, F.lit(start).cast("date")
    return (F.year(d) - F.year(s)) * 12 + F.month(d) - F.month(s)


def _running(monthly: DataFrame, made: Callable[[str], bool]) -> tuple[DataFrame, list[Column]]:
    """Monthly rows with what the running sums are taken of, and the running sums: the fields of an entry, those that are ``made``."""
    w = Window.partitionBy("cust_id").orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
    x = {c: F.col(c).cast("long" if c in LONG_SUMS else "double") for c in (*LONG_SUMS, *DOUBLE_SUMS) if c in monthly.columns}
    out = {"rows": F.count(F.lit(1)).over(w), "late": F.count_if(F.col("delay_sum") > 0).over(w) if "delay_sum" in x else None, "busy": F.count_if(F.col("item_sum") > 0).over(w) if "item_sum" in x else None}
    for c, v in x.items():
        out[c] = F.sum(F.coalesce(v, F.lit(0).cast("long" if c in LONG_SUMS else "double"))).over(w)
        out |= {} if c in COUNTS else {f"n_{c}": F.count(v).over(w)}
    off = lambda c: F.coalesce(x[c].cast("double") - F.first(x[c].cast("double"), ignorenulls=True).over(w), F.lit(0.0))
    spread = [c for c in SPREAD if made(f"off_{c}") or made(f"off2_{c}")]
    monthly = monthly.withColumns({f"__off_{c}": off(c) for c in spread})
    for c in spread:
        out |= {f"off_{c}": F.sum(f"__off_{c}").over(w), f"off2_{c}": F.sum(F.col(f"__off_{c}") * F.col(f"__off_{c}")).over(w)}
    day = F.col("__day").cast("double")
    out["day"] = F.col("__day")
    for c in (c for c in SLOPES.values() if c in x):
        known = F.when(x[c].isNotNull(), day)
        terms = {"t": known, "t2": known * known, "ty": known * x[c].cast("double")}
        out |= {f"{k}_{c}": F.sum(F.coalesce(v, F.lit(0.0))).over(w) for k, v in terms.items()}
    return monthly, [v.alias(n) for n, v in out.items() if n == "rows" or made(n)]


def _field(c: str) -> Callable[[Column], Column]:
    return lambda x: x[c]


def _keyed(c: str, fill: float | None, sign: int) -> Callable[[Column], Column]:
    """(value, month number with a sign, month key) of a month; null without a value."""

    def of(x: Column) -> Column:
        v = x[c] if fill is None else F.coalesce(x[c], F.lit(fill))
        return F.when(v.isNotNull(), F.struct(v.alias("v"), (sign * x["__i"]).alias("i"), x["month_key"].alias("m")))

    return of


def _filled(series: Sequence[tuple[str, str]]) -> tuple[Column, Callable[[Column], Column]]:
    """A month without a row, and what a month's row becomes: its values (null: 0) and zeros up to the next month with a row."""
    none = F.struct(*[F.lit(0.0).alias(n) for n, _ in series])
    own = lambda x: F.struct(*[F.coalesce(x[c].cast("double"), F.lit(0.0)).alias(n) for n, c in series])
    return none, lambda x: F.concat(F.array(own(x)), F.array_repeat(none, x["len"] - 1))


def dealt_by_customer(df: DataFrame) -> DataFrame:
    """Rows dealt out by customer. The number of partitions is named, as Spark would else put partitions together by the size that
    rows have before their windows are made, and tasks would grow with the table."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cust_id")


def _named(reads: Iterable[str] | None) -> tuple[Callable[[str], bool], Callable[[str], bool]]:
    """Whether an entry's field, and an array of the customer, is named in the expressions; without any, those of level 2 are."""
    if reads is None:
        return lambda n: n != "day" and not n.startswith(("t_", "t2_", "ty_")), lambda n: n.startswith("values_")
    text = " ".join(reads)
    fields, words = {*re.findall(r"\b[hl]\.(\w+)", text)}, {*re.findall(r"\w+", text)}
    return fields.__contains__, words.__contains__


def customer_months(monthly: DataFrame, start: str, end: str, reads: Iterable[str] | None = None, series: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One row per customer: months (numbers of those with rows, in order), entries (running sums of the months with rows), upto
    (for each month of the range the number of entries up to it), values_<measure> (in the order of the entries), max_/min_<name>
    (the same, as structs to take the greatest or least of), series (each month of the range, a field for each
    name, 0 without a row).

    ``reads`` are the expressions that will be made of it: what none of them names isn't made. Columns of ``monthly`` that nothing
    is made of may be absent.
    """
    span = month_number(F.lit(end).cast("date"), start) + 1
    entry, array = _named(reads)
    held = dealt_by_customer(monthly.where(F.col("report_month").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))
    held = held.withColumns({"__i": month_number("report_month", start), "__day": F.datediff("report_month", F.lit(start).cast("date"))})
    held, running = _running(held, entry)
    after = F.lead("__i").over(Window.partitionBy("cust_id").orderBy("__i"))
    spread = [m for m in dict.fromkeys([*MEDIANS, *SPREAD]) if array(f"values_{m}")]
    extremes = {n: of for n, of in EXTREMES.items() if array(f"max_{n}") or array(f"min_{n}")}
    values = [F.col(m) for m in dict.fromkeys([*spread, *(c for c, _ in extremes.values()), *(c for _, c in series)])]
    values += [F.col("month_key")] if extremes else []
    light = held.select("cust_id", "__i", (F.coalesce(after, span) - F.col("__i")).alias("len"), *values, F.struct(*running).alias("entry"))
    rows = light.groupBy("cust_id").agg(F.sort_array(F.collect_list(F.struct("__i", "len", *values, "entry"))).alias("r"))
    r, first = F.col("r"), F.get("r", F.lit(0))["__i"]
    upto = F.flatten(F.transform(r, lambda x: F.array_repeat(x["entry"]["rows"].cast("int"), x["len"])))
    out = [F.transform(r, _field("__i")).alias("months"), F.transform(r, _field("entry")).alias("entries"), F.concat(F.array_repeat(F.lit(0), first), upto).alias("upto")]
    out += [F.transform(r, _field(m)).alias(f"values_{m}") for m in spread]
    for name, (c, fill) in extremes.items():
        out += [F.transform(r, _keyed(c, fill, 1)).alias(f"max_{name}"), F.transform(r, _keyed(c, fill, -1)).alias(f"min_{name}")]
    if series:
        none, filled = _filled(series)
        out.append(F.concat(F.array_repeat(none, first), F.flatten(F.transform(r, filled))).alias("series"))
    return rows.select("cust_id", *out)


def months_in(start: str, end: str) -> int:
    """Number of months of the range, both ends included."""
    year, month = int(end[:4]) - int(start[:4]), int(end[5:7]) - int(start[5:7])
    return year * 12 + month + 1


def windows_of(
    customers: DataFrame, start: str, end: str, sizes: Sequence[int], only: Sequence[tuple] | None = None,
    fields: Mapping[str, str] | None = None, measures: Mapping[str, str] | None = None, window_fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """A row for each customer and window inside [start, end] that holds a row: cust_id, window_size, window_end, the measures
    (without any: h and l, the entries at the end and before the start, of which l may be null, and the fields) and the window's
    own fields; with ``only``, of these windows (size, end) alone.

    Windows that hold the same months of a customer have the same measures. So the runs of months that some window holds are made
    first, one row each, and measures are taken of a run once; then its windows become rows. ``fields`` are SQL on the customer's
    columns and x, a run (hi, lo: the numbers of entries up to its last month and before its first), ``measures`` SQL on fields, h
    and l, ``window_fields`` SQL on the customer's columns and y, a window (size, e: the month number of its end). Runs and windows
    are taken of the arrays before they become rows, so that none carries its customer's arrays.
    """
    last = months_in(start, end) - 1
    runs = f"flatten(transform(sequence(1, size(months)), hi -> transform(sequence(coalesce(get(upto, get(months, hi - 1) - {max(sizes, default=1)}), 0), hi - 1), lo -> struct(hi AS hi, lo AS lo))))"
    # A window of size s that holds a run ends in its last month or later, before the next month with a row, and begins in its
    # first month or before, after the last month with a row before.
    least = "greatest(get(months, x.hi - 1), s - 1, coalesce(get(months, x.lo - 1) + s, 0))"
    most = f"least(coalesce(get(months, x.hi) - 1, {last}), get(months, x.lo) + s - 1, {last})"
    each = f"if({least} <= {most}, transform(sequence({least}, {most}), e -> struct(s AS size, e AS e)), array())"
    windows = f"flatten(transform(array({', '.join(map(str, sizes))}), s -> {each}))" if sizes else "cast(array() AS array<struct<size: int, e: int>>)"
    if only is not None:
        # Sizes and ends as one number each; 0 is none, so that the list isn't empty.
        numbers = [0, *(int(w) * 100_000 + months_in(start, str(e)) - 1 for w, e in only)]
        windows = f"filter({windows}, y -> y.size * 100000 + y.e IN ({', '.join(map(str, numbers))}))"
    held = f"filter(transform({runs}, x -> struct(x.hi AS hi, x.lo AS lo, {windows} AS w)), x -> size(x.w) > 0)"
    named = lambda parts: ", ".join(f"{e} AS `{n}`" for n, e in parts.items())
    own = named({"window_size": "y.size", "__e": "y.e", **(window_fields or {})})
    parts = {"h": "get(entries, x.hi - 1)", "l": "get(entries, x.lo - 1)", **(fields or {}), "__w": f"transform(x.w, y -> struct({own}))"}
    out = customers.select("cust_id", F.inline(F.expr(f"transform({held}, x -> struct({named(parts)}))")))
    kept = [F.col("h"), F.col("l"), *map(F.col, fields or {})] if measures is None else [F.expr(e).alias(n) for n, e in measures.items()]
    out = out.select("cust_id", *kept, "__w").select("*", F.inline("__w")).drop("__w")
    return out.withColumn("window_end", F.add_months(F.trunc(F.lit(start).cast("date"), "month"), F.col("__e"))).drop("__e")


def size_ranges_of(customers: DataFrame, start: str, end: str, least: int, most: int, measures: Mapping[str, str], window_fields: Mapping[str, str]) -> DataFrame:
    """The windows inside [start, end] of all sizes from ``least`` to ``most`` that hold a row, one row for the sizes at which windows
    of one customer and end hold the same months and days: cust_id, size_from, size_to, window_end, measures, window fields (of
    size_from). ``customers`` have days_upto too.

    Starts between two months with rows or days, the later one included, make no difference, so a row is made for each end and month.
    """
    last = months_in(start, end) - 1
    grows = lambda c: f"coalesce(get({c}, i), 0) > coalesce(get({c}, i - 1), 0)"
    held = customers.withColumn("__cuts", F.expr(f"filter(sequence(0, {last}), i -> {grows('upto')} OR {grows('days_upto')})"))
    before = "get(__cuts, j - 1)"
    each = f"struct(e, greatest(e - c + 1, {least}) AS size, least(e - coalesce({before}, -1), {most}) AS size_to, coalesce(get(upto, {before}), 0) AS lo, get(upto, e) AS hi)"
    # Behind the end no cut gives a window that holds a row.
    rows = f"flatten(transform(sequence(0, {last}), e -> filter(transform(filter(__cuts, c -> c <= e), (c, j) -> {each}), y -> y.size <= y.size_to AND y.hi > y.lo)))"
    parts = {"size_from": "y.size", "size_to": "y.size_to", "__e": "y.e", "h": "get(entries, y.hi - 1)", "l": "get(entries, y.lo - 1)", **window_fields}
    own = ", ".join(f"{e} AS `{n}`" for n, e in parts.items())
    out = held.select("cust_id", F.inline(F.expr(f"transform({rows}, y -> struct({own}))")))
    out = out.withColumn("window_end", F.add_months(F.trunc(F.lit(start).cast("date"), "month"), F.col("__e")))
    return out.select("cust_id", "size_from", "size_to", "window_end", *[F.expr(e).alias(n) for n, e in measures.items()], *window_fields)


# Expressions are SQL text from here on: a window's row has some sixty of them, each of many parts.


def within(c: str) -> str:
    """Sum of a running measure over the window."""
    return f"(h.{c} - coalesce(l.{c}, 0))"


def in_window(c: str) -> str:
    """Slice of an array over the months with rows: those of the run ``x``."""
    return f"slice({c}, x.lo + 1, x.hi - x.lo)"


def total(c: str, kind: str) -> str:
    return f"cast({within(c)} AS {kind})" if c in COUNTS else f"cast(if({within(f'n_{c}')} > 0, {within(c)}, null) AS {kind})"


def mean(c: str) -> str:
    return f"try_divide(cast({within(c)} AS double), cast({within(f'n_{c}')} AS double))"


def deviation(c: str, values: str) -> str:
    """Population deviation; exactly 0 where all values are equal."""
    n, off, off2 = within(f"n_{c}"), within(f"off_{c}"), within(f"off2_{c}")
    return f"CASE WHEN {n} > 0 THEN if(array_min({values}) = array_max({values}), 0D, sqrt(greatest({off2} - {off} * {off} / {n}, 0D) / {n})) END"


def median(values: str, n: str) -> str:
    """Middle of the last ``n`` of the sorted values (nulls come first)."""
    at = lambda k: f"cast(get(sort_array({values}), cast(size({values}) - {n} + {k} AS int)) AS double)"
    return f"CASE WHEN {n} > 0 THEN ({at(f'({n} - 1) div 2')} + {at(f'{n} div 2')}) / 2 END"


def slope(c: str) -> str:
    """Least-squares slope of a measure on seconds; 0 where undefined. Sums about the last month with a row follow from running ones."""
    n, t, t2, ty, y = within(f"n_{c}"), within(f"t_{c}"), within(f"t2_{c}"), within(f"ty_{c}"), f"cast({within(c)} AS double)"
    x, x2, xy = f"({t} - {n} * h.day)", f"({t2} - 2 * h.day * {t} + {n} * cast(h.day AS double) * h.day)", f"({ty} - h.day * {y})"
    return f"coalesce(try_divide({n} * {xy} - {x} * {y}, {n} * {x2} - {x} * {x}) / 86400.0D, 0D)"


def extreme(name: str) -> dict[str, str]:
    """Fields of a window."""
    return {f"{name}_max_month": f"array_max({in_window(f'max_{name}')}).m", f"{name}_min_month": f"array_min({in_window(f'min_{name}')}).m"}
