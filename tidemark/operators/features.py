"""Customer features: the monthly level, the grid of sliding windows, lifetime rows, exponential trends.

The whole grid of windows is one job. Measures of windows come from one row per customer with an array of running sums by
month (``month_arrays``): a window is made of two entries and some slices, behind the last aggregation. ``to_windows`` hands
single rows to the windows they belong to, for aggregations of another kind.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import first_label, safe_ratio, yymm
from tidemark.operators import month_arrays as A

#: Service letters in the order that breaks ties.
SERVICES = ("c", "e", "m", "p", "r", "u", "l", "q")
PIVOTS = ("item", "revenue", "complaint", "delay", "nodone", "order_score", "satisfaction")
_PIVOT_SOURCE = {"order_score": "order_score_avg", "satisfaction": "satisfaction_avg"}
WINDOW_KEY = ("cust_id", "window_size", "window_end")


def _monthly_parts() -> dict[str, tuple[str | None, Column]]:
    """Measures of level 1, the column of a customer's month that each is made of, and how."""
    total = lambda c, t="long": (c, F.sum(c).cast(t))
    return {
        "item_sum": total("item_count"), "revenue_sum": total("total_fee"), "complaint_sum": total("total_complaint"),
        "delay_sum": total("delay_count"), "nodone_sum": total("nodone"),
        "order_score_avg": ("order_score", F.avg("order_score")), "satisfaction_avg": ("satisfaction_score", F.avg("satisfaction_score")),
        "month_record_count": (None, F.count(F.lit(1))), "months_with_complaint": ("total_complaint", F.count_if(F.col("total_complaint") > 0)),
        "weight_sum": total("weight_kg", "double"), "delay_day_sum": total("delay_day", "double"),
        "refund_sum": total("refunded", "double"), "noaccepted_sum": total("noaccepted", "double"),
        "lost_sum": total("lost_order", "double"), "intra_prov_sum": total("intra_province", "double"),
        "intl_sum": total("international", "double"), "avg_lastday": ("lastday", F.avg("lastday")),
        **{f"ser_{s}": (f"ser_{s}", F.sum(F.coalesce(f"ser_{s}", F.lit(0))).cast("long")) for s in SERVICES},
    }


def agg_monthly(cust_month: DataFrame, since: str | None = None) -> DataFrame:
    """Level 1: one row per customer and month; measures of columns that aren't there are left out."""
    if since:
        cust_month = cust_month.where(F.col("report_month") >= F.lit(since).cast("date"))
    parts = {n: e for n, (c, e) in _monthly_parts().items() if c is None or c in cust_month.columns}
    rows = cust_month.groupBy("cust_id", F.trunc("report_month", "month").alias("report_month")).agg(*[e.alias(n) for n, e in parts.items()])
    return rows.withColumn("month_key", yymm(F.col("report_month")))


def window_grid(spark, start: str, end: str, sizes: Sequence[int]) -> DataFrame:
    """window_size, window_start, window_end, name: all windows of the sizes that lie inside [start, end]."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    ends = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("window_end"))
    grid = ends.select(F.explode(F.array(*map(F.lit, sizes))).alias("window_size"), "window_end")
    begin = F.add_months("window_end", 1 - F.col("window_size"))
    name = F.concat(F.lit("cus_feature_"), F.col("window_size"), F.lit("m_"), F.date_format("window_start", "yyMM"), F.lit("_"), F.date_format("window_end", "yyMM"))
    return grid.withColumn("window_start", begin).where(F.col("window_start") >= first).select("window_size", "window_start", "window_end", name.alias("name"))


def to_windows(df: DataFrame, month: Column, start: str, end: str, sizes: Sequence[int], dealt: bool = True) -> DataFrame:
    """Each row once for every (window_size, window_end) whose months hold ``month``, as long as the window lies in [start, end].

    With ``dealt`` the rows are dealt out by customer before they are copied; an aggregation by customer and window then
    moves no copy.
    """
    m = F.trunc(month, "month")
    df = A.dealt_by_customer(df) if dealt else df
    size = F.col("window_size")
    ends = F.sequence(F.col("__m"), F.least(F.add_months("__m", size - 1), F.lit(end).cast("date")), F.expr("INTERVAL 1 MONTH"))
    return (
        df.withColumn("__m", m)
        .where(F.col("__m").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .withColumn("window_size", F.explode(F.array(*map(F.lit, sizes))))
        .withColumn("window_end", F.explode(ends))
        .where(F.add_months("window_end", 1 - size) >= F.lit(start).cast("date"))
        .drop("__m")
    )


def window_totals(monthly: DataFrame, start: str, end: str, sizes: Sequence[int]) -> DataFrame:
    """window_size, window_end, n_rows, n_customers, items, revenue of every window with rows; ``monthly`` has a row per customer and month.

    A customer counts at its first row of a window, which is known by the gap to the row before. So rows are added up by month
    and gap, and only those sums meet the windows.
    """
    before = F.lag("__i").over(Window.partitionBy("cust_id").orderBy("__i"))
    inside = F.trunc("report_month", "month").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    own = monthly.where(inside).select("cust_id", "report_month", "item_sum", "revenue_sum", A.month_number("report_month", start).alias("__i"))
    by = own.withColumn("__before", before).groupBy("report_month", "__before").agg(
        F.count(F.lit(1)).alias("n"), F.count("cust_id").alias("known"), F.sum("item_sum").alias("items"), F.sum("revenue_sum").alias("revenue")
    )
    held = to_windows(by, F.col("report_month"), start, end, sizes, dealt=False)
    first = F.col("__before").isNull() | (F.col("__before") <= A.month_number("window_end", start) - F.col("window_size"))
    return held.groupBy("window_size", "window_end").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(first, F.col("known")).otherwise(0)).alias("n_customers"), F.sum("items").alias("items"), F.sum("revenue").alias("revenue")
    )


#: What a month's sum is called in a window's row, where the name differs.
_SUM_NAMES = {"months_with_complaint": "months_with_complaint_ct", **{f"ser_{x}": f"ser_{x}_sum" for x in SERVICES}}


def _slices(measures: Sequence[str]) -> dict[str, str]:
    return {f"s_{m}": A.in_window(f"values_{m}") for m in measures}


def base_measures() -> dict[str, str]:
    """Level 2: sums, means, population deviations, medians and extremes of a window."""
    out = {"month_count": A.within("rows")}
    for c in A.MEDIANS:
        m, s = c.removesuffix("_sum"), f"s_{c}"
        out |= {c: A.total(c, "long"), f"{m}_avg": A.mean(c), f"{m}_std": A.deviation(c, s), f"{m}_median": A.median(s, A.within(f"n_{c}")), f"{m}_max": f"array_max({s})", f"{m}_min": f"array_min({s})"}
    out |= {"weight_sum": A.total("weight_sum", "double"), "weight_avg": A.mean("weight_sum"), "weight_std": A.deviation("weight_sum", "s_weight_sum")}
    out |= {c: A.total(c, "double") for c in A.DOUBLE_SUMS if c.endswith("_sum") and c != "weight_sum"}
    for c in ("order_score_avg", "satisfaction_avg"):
        out |= {c: A.mean(c), c.replace("_avg", "_std"): A.deviation(c, f"s_{c}")}
    out |= {n: A.total(c, "long") for c, n in _SUM_NAMES.items()}
    # A customer's month has one row, so the months with items need no set.
    return out | {"delay_count_ct": A.within("late"), "active_months": A.within("busy"), "avg_lastday": A.mean("avg_lastday")}


def _of(names: Sequence[str] | None, parts: Mapping[str, str]) -> dict[str, str]:
    return {n: e for n, e in parts.items() if names is None or n in names}


def _fields_of(measures: Mapping[str, str]) -> dict[str, str]:
    """Slices that the measures are made of."""
    text = " ".join(measures.values())
    return {n: e for n, e in _slices(A.SPREAD).items() if f"{n})" in text}


def agg_window_base(monthly: DataFrame, start: str, end: str, sizes: Sequence[int], only: Sequence[tuple] | None = None, measures: Sequence[str] | None = None) -> DataFrame:
    """The measures of level 2 per customer and window (None: all of them); with ``only``, of these windows (size, end) alone."""
    made = _of(measures, base_measures())
    fields = _fields_of(made)
    held = A.windows_of(A.customer_months(monthly, start, end, [*made.values(), *fields.values()]), start, end, sizes, only, fields, made)
    return held.select(*WINDOW_KEY, *(made if measures is None else measures))


def extreme_months() -> dict[str, str]:
    """Month of the greatest and least value; ties go to the newest month; a null score ranks lowest, another null value nowhere."""
    return {n: e for name in A.EXTREMES for n, e in A.extreme(name).items()}


def win_extreme_months(monthly: DataFrame, start: str, end: str, sizes: Sequence[int]) -> DataFrame:
    made = extreme_months()
    held = A.windows_of(A.customer_months(monthly, start, end, made.values()), start, end, sizes, fields=made, measures={n: n for n in made})
    return held.select(*WINDOW_KEY, *made)


def slopes() -> dict[str, str]:
    """Least-squares slopes; 0 where undefined."""
    return {name: A.slope(c) for name, c in A.SLOPES.items()}


def window_slopes(monthly: DataFrame, start: str, end: str, sizes: Sequence[int]) -> DataFrame:
    made = slopes()
    held = A.windows_of(A.customer_months(monthly, start, end, made.values()), start, end, sizes, measures=made)
    return held.select(*WINDOW_KEY, *made)


def _series_of(metrics: Sequence[str]) -> list[tuple[str, str]]:
    return [(m, _PIVOT_SOURCE.get(m, f"{m}_sum")) for m in metrics]


def _held_series(metrics: Sequence[str]) -> dict[str, str]:
    """Months of a window, oldest first, all metrics of a month together."""
    return {"__series": "slice(series, y.e - y.size + 2, y.size)"} if metrics else {}


def _series(metrics: Sequence[str]) -> list[Column]:
    return [F.col(f"__series.{m}").alias(f"{m}_months") for m in metrics]


def win_pivot_months(in_windows: DataFrame, size: int, metrics: Sequence[str] = PIVOTS) -> DataFrame:
    """For windows of one size: ``<metric>_last, <metric>_1m_ago, ...``; missing months are 0."""
    ago = F.months_between("window_end", "report_month").cast("int")
    out = []
    for k in range(size):
        for m in metrics:
            c = F.max(F.when(ago == k, F.col(_PIVOT_SOURCE.get(m, f"{m}_sum"))))
            out.append(F.coalesce(c, F.lit(0)).alias(f"{m}_last" if k == 0 else f"{m}_{k}m_ago"))
    return in_windows.where(F.col("window_size") == size).groupBy(*WINDOW_KEY).agg(*out)


def month_series_arrays(monthly: DataFrame, start: str, end: str, sizes: Sequence[int], metrics: Sequence[str] = PIVOTS) -> DataFrame:
    """For all sizes: one array per metric, oldest month first, missing months 0."""
    held = A.windows_of(A.customer_months(monthly, start, end, (), _series_of(metrics)), start, end, sizes, measures={}, window_fields=_held_series(metrics))
    return held.select(*WINDOW_KEY, *_series(metrics))


def _by_month(rows: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Rows whose month lies in the range, with ``__i`` (its number) and ``__first`` (whether the date is the first of its month)."""
    inside = F.trunc(date, "month").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return rows.where(inside).withColumns({"__i": A.month_number(date, start), "__first": F.dayofmonth(date) == 1})


def _upto(first: Column) -> Column:
    """For each month of the range the number of entries of ``r`` up to it; ``len`` says how many months an entry lasts."""
    each = F.flatten(F.transform("r", lambda x, i: F.array_repeat(i + 1, x["len"])))
    return F.concat(F.array_repeat(F.lit(0), first), each)


def customer_complaints(complaints: DataFrame, start: str, end: str) -> DataFrame:
    """cust_id, codes, first_codes (for each month with complaints the codes with their counts: of the whole month and of its first
    day alone), codes_upto (for each month of the range the number of those months up to it). Counted by customer, month and
    code before anything is gathered."""
    span = A.month_number(F.lit(end).cast("date"), start) + 1
    own = _by_month(complaints.where("complaint_code IS NOT NULL"), "create_date", start, end)
    by = own.groupBy("cust_id", "__i", "complaint_code").agg(F.count(F.lit(1)).alias("n"), F.count_if("__first").alias("n1"))
    code = lambda n: F.struct(F.col("complaint_code").alias("c"), F.col(n).alias("n"))
    months = by.groupBy("cust_id", "__i").agg(F.collect_list(code("n")).alias("a"), F.collect_list(F.when(F.col("n1") > 0, code("n1"))).alias("b"))
    after = F.lead("__i").over(Window.partitionBy("cust_id").orderBy("__i"))
    lengths = months.withColumn("len", F.coalesce(after, span) - F.col("__i"))
    packed = lengths.groupBy("cust_id").agg(F.sort_array(F.collect_list(F.struct("__i", "len", "a", "b"))).alias("r"))
    return packed.select("cust_id", F.expr("transform(r, x -> x.a)").alias("codes"), F.expr("transform(r, x -> x.b)").alias("first_codes"), _upto(F.get("r", F.lit(0))["__i"]).alias("codes_upto"))


def _held_codes() -> dict[str, str]:
    """Codes with counts of a window, which ends on the first day of its last month; null without a complaint."""
    at = lambda k: f"coalesce(get(codes_upto, {k}), 0)"
    lo, hi, now = at("y.e - y.size"), at("y.e - 1"), at("y.e")
    last = f"if({now} > {hi}, get(first_codes, {now} - 1), slice(get(first_codes, 0), 1, 0))"
    return {"__held": f"if({now} > {lo}, concat(flatten(slice(codes, {lo} + 1, {hi} - {lo})), {last}), null)"}


def _complaint_columns() -> list[Column]:
    """complaint_diversity and most_common_complaint (least on ties) of a window's codes; both null without a complaint."""
    kinds = "array_distinct(transform(__held, y -> y.c))"
    of = "aggregate(__held, 0L, (n, y) -> n + if(y.c = c, y.n, 0L))"
    some = "size(__held) > 0"
    return [F.expr(f"if({some}, cast(size({kinds}) AS long), null)").alias("complaint_diversity"), F.expr(f"if({some}, array_min(transform({kinds}, c -> struct(-{of} AS n, c AS c))).c, null)").alias("most_common_complaint")]


def customer_days(items: DataFrame, start: str, end: str) -> DataFrame:
    """cust_id, days (for each month with sending days: n of them up to its end, f: whether its first day is one, last: the last
    one), days_upto (for each month of the range the number of those months up to it)."""
    span = A.month_number(F.lit(end).cast("date"), start) + 1
    dates = _by_month(items.select("cust_id", "send_date").distinct(), "send_date", start, end)
    by = dates.groupBy("cust_id", "__i").agg(F.count(F.lit(1)).alias("n"), F.bool_or("__first").alias("f"), F.max("send_date").alias("last"))
    w = Window.partitionBy("cust_id").orderBy("__i")
    upto = by.select("cust_id", "__i", F.sum("n").over(w).alias("n"), "f", "last", (F.coalesce(F.lead("__i").over(w), span) - F.col("__i")).alias("len"))
    packed = upto.groupBy("cust_id").agg(F.sort_array(F.collect_list(F.struct("__i", "len", "n", "f", "last"))).alias("r"))
    return packed.select("cust_id", F.expr("transform(r, x -> struct(x.n AS n, x.f AS f, x.last AS last))").alias("days"), _upto(F.get("r", F.lit(0))["__i"]).alias("days_upto"))


def _held_days() -> dict[str, str]:
    """Sending days up to a window's start, up to its last month, and of that month (null without a day in it)."""
    at = lambda k: f"coalesce(get(days_upto, {k}), 0)"
    lo, hi, now = at("y.e - y.size"), at("y.e - 1"), at("y.e")
    return {"__d_lo": f"get(days, {lo} - 1)", "__d_hi": f"get(days, {hi} - 1)", "__d_now": f"if({now} > {hi}, get(days, {now} - 1), null)"}


def _day_columns() -> list[Column]:
    """active_days (0 without any), window_days and recency_days (null then) of a window, which ends on the first day of its last month."""
    on_end = "coalesce(__d_now.f, false)"
    n = f"cast(coalesce(__d_hi.n, 0) - coalesce(__d_lo.n, 0) + if({on_end}, 1, 0) AS int)"
    first = "add_months(window_end, 1 - window_size)"
    return [
        F.expr(n).alias("active_days"), F.expr(f"if({n} > 0, datediff(window_end, {first}) + 1, null)").alias("window_days"),
        F.expr(f"if({n} > 0, datediff(window_end, if({on_end}, window_end, __d_hi.last)), null)").alias("recency_days"),
    ]


def _all_windows(customers: DataFrame, start: str, end: str, sizes: Sequence[int], fields: Mapping[str, str]) -> DataFrame:
    """A row for each customer and window inside [start, end]: cust_id, window_size, window_end, and the fields (``A.windows_of``)."""
    months = A.months_in(start, end)
    windows = ", ".join(f"transform(sequence({s} - 1, {months - 1}), e -> struct({s} AS size, e AS e))" for s in sizes if s <= months)
    parts = ", ".join(f"{e} AS `{n}`" for n, e in {"window_size": "y.size", "__e": "y.e", **fields}.items())
    out = customers.select("cust_id", F.inline(F.expr(f"transform(concat({windows or 'array()'}), y -> struct({parts}))")))
    return out.withColumn("window_end", F.add_months(F.trunc(F.lit(start).cast("date"), "month"), F.col("__e")))


def complaint_stats(complaints: DataFrame, start: str, end: str, sizes: Sequence[int]) -> DataFrame:
    """Distinct codes and the most common code (least on ties) per window.

    A window ends on the first day of its last month here, as months are compared by date.
    """
    held = _all_windows(customer_complaints(complaints, start, end), start, end, sizes, _held_codes())
    return held.where(F.size("__held") > 0).select(*WINDOW_KEY, *_complaint_columns())


def send_day_stats(items: DataFrame, start: str, end: str, sizes: Sequence[int]) -> DataFrame:
    """Active days, days in the window and days since the last sending; (customer, day) pairs are made distinct first."""
    held = _all_windows(customer_days(items, start, end), start, end, sizes, _held_days())
    return held.select(*WINDOW_KEY, *_day_columns()).where("active_days > 0")


def service_mix(prefix: str = "ser_", suffix: str = "_sum", none: str = "E", zero: str | None = None) -> list[Column]:
    """service_types_used, dominant_service, dominant_service_ratio of a row's eight sums."""
    sums = [(s.upper(), F.col(f"{prefix}{s}{suffix}")) for s in SERVICES]
    used = sum((F.when(v > 0, 1).otherwise(0) for _, v in sums[1:]), F.when(sums[0][1] > 0, 1).otherwise(0))
    top = F.greatest(*[v for _, v in sums])
    total = sum((v for _, v in sums[1:]), sums[0][1])
    dominant = first_label(sums, none)
    if zero is not None:
        dominant = F.when(top == 0, F.lit(zero)).otherwise(dominant)
    return [used.alias("service_types_used"), dominant.alias("dominant_service"), safe_ratio(top, total).alias("dominant_service_ratio")]


#: Ratios of a window's measures.
RATIOS = {
    "avg_revenue_per_item": ("revenue_sum", "item_sum"), "avg_weight_per_item": ("weight_sum", "item_sum"), "pct_delay": ("delay_sum", "item_sum"), "pct_refund": ("refund_sum", "item_sum"),
    "pct_noaccepted": ("noaccepted_sum", "item_sum"), "pct_lost_order": ("lost_sum", "item_sum"), "pct_complaint": ("complaint_sum", "item_sum"),
    "pct_complaint_per_item": ("months_with_complaint_ct", "month_count"), "pct_successful_item": ("nodone_sum", "item_sum"), "pct_intra_province": ("intra_prov_sum", "item_sum"),
    "pct_international": ("intl_sum", "item_sum"), "avg_delayday": ("delay_day_sum", "delay_count_ct"),
}
_DAYS = ("active_days", "window_days", "recency_days")
#: What else is made of a window's measures, and of which.
_MADE_OF = {
    **RATIOS, "cv_item": ("item_std", "item_avg"), "cv_revenue": ("revenue_std", "revenue_avg"), "item_range": ("item_max", "item_min"), "revenue_range": ("revenue_max", "revenue_min"),
    "inactive_months": ("active_months",), "active_days": _DAYS, "inactive_days": _DAYS, "avg_noservice_days": _DAYS, "max_consecutive_inactive": (),
    **{n: tuple(f"ser_{x}_sum" for x in SERVICES) for n in ("service_types_used", "dominant_service", "dominant_service_ratio")},
    "recency": _DAYS, "frequency": ("item_sum", "active_months"), "monetary": ("revenue_sum", "active_months"), "most_common_complaint": ("__held",), "complaint_diversity": ("__held",),
}


def ratios() -> list[Column]:
    """The ratio family of a window row."""
    top = lambda n, c: F.col("item_sum") - F.col(c) if n == "pct_successful_item" else F.col(c)
    return [safe_ratio(top(n, a), F.col(b)).alias(n) for n, (a, b) in RATIOS.items()]


def volatility() -> list[Column]:
    return [
        safe_ratio(F.col("item_std"), F.col("item_avg")).alias("cv_item"), safe_ratio(F.col("revenue_std"), F.col("revenue_avg")).alias("cv_revenue"),
        (F.col("item_max") - F.col("item_min")).alias("item_range"), (F.col("revenue_max") - F.col("revenue_min")).alias("revenue_range"),
    ]


def activity() -> list[Column]:
    """inactive_days stays null for a customer without item rows, though active_days is 0 then; the last column is 0 by definition."""
    idle = F.col("window_days") - F.coalesce("active_days", F.lit(0))
    return [
        (F.col("window_size") - F.col("active_months")).alias("inactive_months"), F.coalesce("active_days", F.lit(0)).alias("active_days"), idle.alias("inactive_days"),
        (idle / F.greatest(F.ceil(F.col("window_days") / 30.0), F.lit(1))).alias("avg_noservice_days"), F.lit(0).alias("max_consecutive_inactive"),
    ]


def rfm() -> list[Column]:
    return [
        F.coalesce("recency_days", F.lit(0)).alias("recency"), safe_ratio(F.col("item_sum"), F.col("active_months")).alias("frequency"),
        safe_ratio(F.col("revenue_sum"), F.col("active_months")).alias("monetary"),
    ]


#: Families of derived columns and the names that they give, in the order of a feature row.
FAMILIES = {
    "ratios": tuple(RATIOS), "volatility": ("cv_item", "cv_revenue", "item_range", "revenue_range"),
    "activity": ("inactive_months", "active_days", "inactive_days", "avg_noservice_days", "max_consecutive_inactive"),
    "service_mix": ("service_types_used", "dominant_service", "dominant_service_ratio"), "rfm": ("recency", "frequency", "monetary"),
}


def _needed(columns: Sequence[str] | None) -> set[str] | None:
    return None if columns is None else {*columns, *(m for c in columns for m in _MADE_OF.get(c, ()))}


def levels_read(columns: Sequence[str] | None, with_months: bool = True) -> tuple[list[str], bool, bool]:
    """What ``window_features`` reads for these columns (None: all): columns of a customer's month, and whether complaints and sending
    days too."""
    needed, parts = _needed(columns), _monthly_parts()
    made = {n: e for part in (base_measures, slopes) for n, e in _of(needed, part()).items()}
    text = " ".join(made.values())
    read = {c for c in parts if c in text} | ({"delay_sum"} if "h.late" in text else set()) | ({"item_sum"} if "h.busy" in text else set())
    read |= {A.EXTREMES[name][0] for name in A.EXTREMES if _of(needed, A.extreme(name))}
    read |= {c for m, c in _series_of(PIVOTS if with_months else ()) if needed is None or f"{m}_months" in needed}
    codes, days = (needed is None or bool(needed & {*names}) for names in (("__held",), _DAYS))
    return [c for c in dict.fromkeys(c for n, (c, _) in parts.items() if n in read) if c], codes, days


def window_features(
    monthly: DataFrame, complaints: DataFrame | None, items: DataFrame, start: str, end: str, sizes: Sequence[int], with_months: bool = True, columns: Sequence[str] | None = None,
) -> DataFrame:
    """The full row per customer and window, for all sizes in one job; with ``columns`` the key and these, and only what they are
    made of is made and need be there.

    Months, complaints and sending days become one row per customer each, dealt out by customer; their joins need no exchange
    of their own, and windows are made of the joined row.
    """
    hidden = {*_DAYS, "month_count", "months_with_complaint_ct", "delay_count_ct", "item_max", "item_min", "revenue_max", "revenue_min", "complaint_max", "complaint_min"}
    needed = _needed(columns)
    measures, extremes, lines = (_of(needed, part()) for part in (base_measures, extreme_months, slopes))
    metrics = [m for m in (PIVOTS if with_months else ()) if needed is None or f"{m}_months" in needed]
    codes, days = (needed is None or needed & {*names} for names in (("__held",), _DAYS))
    fields = {**_fields_of(measures), **extremes}
    own = A.customer_months(monthly, start, end, [*measures.values(), *lines.values(), *fields.values()], _series_of(metrics))
    own = own.join(customer_complaints(complaints, start, end), "cust_id", "left") if codes else own
    own = own.join(customer_days(items, start, end), "cust_id", "left") if days else own
    window_fields = {**(_held_codes() if codes else {}), **(_held_days() if days else {}), **_held_series(metrics)}
    made = {**measures, **{n: n for n in extremes}, **lines}
    held = A.windows_of(own, start, end, sizes, fields=fields, measures=made, window_fields=window_fields)
    held = held.select(*WINDOW_KEY, *made, *(["__held"] if codes else []), *(_day_columns() if days else []), *_series(metrics))
    derived = []
    if codes:
        diversity, most_common = _complaint_columns()
        derived += [most_common, F.coalesce(diversity, F.lit(0)).alias("complaint_diversity")]
    for family, names in zip((ratios, volatility, activity, service_mix, rfm), FAMILIES.values(), strict=True):
        derived += [c for n, c in zip(names, family(), strict=True) if columns is None or n in columns]
    # The last step has functions of arrays; Spark then makes many small methods of its expressions, not one that is too long
    # for the JVM to compile.
    shown = [c for c in held.columns if c != "__held" and (c not in hidden if columns is None else c in (*WINDOW_KEY, *columns) and c not in _MADE_OF)]
    out = held.select(*shown, *derived)
    return out if columns is None else out.select(*WINDOW_KEY, *[c for c in columns if c not in WINDOW_KEY])


def size_range_features(monthly: DataFrame, items: DataFrame, start: str, end: str, least: int, most: int, columns: Sequence[str]) -> DataFrame:
    """cust_id, size_from, size_to, window_end and ``columns`` (sums, means, recency) of the windows of all sizes from ``least`` to
    ``most``: a row for each range of sizes whose windows hold the same months and days, and so have the same values."""
    measures = _of([c for c in columns if c != "recency"], base_measures())
    if _fields_of(measures) or {*columns} - {*measures, "recency"}:
        raise ValueError("only sums, means and recency are made by ranges of sizes")
    own = A.customer_months(monthly, start, end, [*measures.values()]).join(customer_days(items, start, end), "cust_id", "left")
    held = A.size_ranges_of(own, start, end, least, most, measures, _held_days())
    held = held.select("cust_id", "size_from", "size_to", "window_end", *measures, _day_columns()[-1])
    return held.withColumn("recency", F.coalesce("recency_days", F.lit(0))).select("cust_id", "size_from", "size_to", "window_end", *columns)


def ewma(months: Column, alpha: float, size: int | None = None) -> Column:
    """Exponentially weighted mean of an array, oldest first (null: 0): struct (ewma, delta to the value one month before).

    With one month the mean is that value and the delta 0; with none both are 0. ``size`` says that all arrays have so many
    months; the steps are then written out, which Spark compiles, and are the same.
    """
    if size:
        x = [F.coalesce(F.get(months, F.lit(i)).cast("double"), F.lit(0.0)) for i in range(size)]
        prev = cur = x[0]
        for v in x[1:]:
            prev, cur = cur, F.lit(alpha) * v + F.lit(1 - alpha) * cur
        return F.struct(cur.alias("ewma"), (cur - prev).alias("delta"))
    x = F.transform(months, lambda v: F.coalesce(v.cast("double"), F.lit(0.0)))
    first = F.coalesce(F.get(x, F.lit(0)), F.lit(0.0))
    start = F.struct(first.alias("prev"), first.alias("cur"))
    step = lambda a, v: F.struct(a["cur"].alias("prev"), (F.lit(alpha) * v + F.lit(1 - alpha) * a["cur"]).alias("cur"))
    return F.aggregate(F.slice(x, 2, F.greatest(F.size(x), F.lit(1))), start, step, lambda a: F.struct(a["cur"].alias("ewma"), (a["cur"] - a["prev"]).alias("delta")))


#: Trend names and the month arrays behind them. ``order`` reads the order score.
TREND_SOURCES = {"item": "item", "revenue": "revenue", "complaint": "complaint", "delay": "delay", "nodone": "nodone", "order": "order_score", "satisfaction": "satisfaction"}


def add_ewma(features: DataFrame, alpha: float = 0.3, sources: dict[str, str] | None = None, size: int | None = None) -> DataFrame:
    """ewma_<m> and delta_ewma_<m> for every trend, and the item trend again as ewma, delta_ewma. A missing array gives 0; ``size``
    says that all arrays have so many months."""
    out = features
    for name, source in (sources or TREND_SOURCES).items():
        c = f"{source}_months"
        e = ewma(F.col(c), alpha, size) if c in features.columns else ewma(F.array().cast("array<double>"), alpha)
        out = out.withColumn("__e", e).withColumns({f"ewma_{name}": F.col("__e.ewma"), f"delta_ewma_{name}": F.col("__e.delta")}).drop("__e")
    return out.withColumns({"ewma": F.col("ewma_item"), "delta_ewma": F.col("delta_ewma_item")})


def lifetime_features(cust_month: DataFrame, info: DataFrame, items: DataFrame, as_of: str, since: str | None = None) -> DataFrame:
    """One row per customer over all months since ``since``: totals, quality ratios, scores, services, places, profile.

    Of several profile rows of a customer the one with the latest contract date is taken (then the largest tenure).
    """
    if since:
        cust_month = cust_month.where(F.col("report_month") >= F.lit(since).cast("date"))
        items = items.where(F.col("send_date") >= F.lit(since).cast("date"))
    n = F.sum("item_count")
    rate = lambda c, name: safe_ratio(F.sum(c), n).alias(name)
    late = F.col("delay_count") > 0
    months = cust_month.groupBy("cust_id").agg(
        n.alias("lifetime_total_items"), F.sum("total_fee").alias("lifetime_total_revenue"), F.sum("weight_kg").cast("double").alias("lifetime_total_weight"),
        F.sum("total_complaint").alias("lifetime_total_complaint"), rate("total_fee", "lifetime_avg_revenue_per_item"), rate("weight_kg", "lifetime_avg_weight_per_item"),
        F.count("report_month").alias("lifetime_months_active"), F.min("report_month").alias("__first"), rate("delay_count", "lifetime_pct_delay"),
        rate("refunded", "lifetime_pct_refund"), rate("noaccepted", "lifetime_pct_noaccepted"), rate("lost_order", "lifetime_pct_lost_order"),
        rate("total_complaint", "lifetime_pct_complaint"), F.coalesce(1 - F.try_divide(F.sum("nodone").cast("double"), n.cast("double")), F.lit(0.0)).alias("lifetime_pct_successful_item"),
        safe_ratio(F.sum(F.when(late, F.col("delay_day")).otherwise(0)), F.count_if(late)).alias("lifetime_avg_delayday"),
        F.coalesce(F.avg("order_score"), F.lit(0.0)).alias("lifetime_avg_order_score"), F.coalesce(F.avg("satisfaction_score"), F.lit(0.0)).alias("lifetime_avg_satisfaction"),
        rate("international", "lifetime_pct_international"), safe_ratio(F.count_if(F.col("intra_province") == 1), n).alias("lifetime_pct_intra_province"),
        *[F.sum(F.coalesce(f"ser_{s}", F.lit(0))).alias(f"ser_{s}") for s in SERVICES],
    )
    pick = F.struct(F.col("contract_date").isNotNull(), "contract_date", "tenure")
    profile = info.groupBy("cust_id").agg(F.max_by(F.struct("custype", "province", "tenure", "contract_date"), pick).alias("p")).select("cust_id", "p.*")
    sent = items.groupBy("cust_id").agg(
        F.countDistinct("send_date").alias("lifetime_days_active"),
        F.coalesce(F.try_divide(F.count_if(F.col("complaint") > 0).cast("double"), F.nullif(F.count(F.lit(1)), F.lit(1)).cast("double")), F.lit(0.0)).alias("lifetime_pct_complaint_per_item"),
        F.mode("rec_province", True).alias("most_common_rec_province"), F.mode("region", True).cast("string").alias("most_common_region"),
    )
    used, dominant, _ = service_mix(suffix="", none="U", zero="U")
    begun = F.coalesce("contract_date", F.trunc("__first", "month"))
    whole_months = F.floor(F.months_between(F.lit(as_of).cast("date"), begun)).cast("int")
    joined = months.join(profile, "cust_id", "left").join(sent, "cust_id", "left")
    return joined.select(
        "cust_id", (F.substring(F.col("cust_id").cast("string"), 1, 1) == "T").alias("is_corporate"), F.coalesce("custype", F.lit(1)).alias("custype"),
        begun.alias("contract_sig_first"), F.coalesce("tenure", whole_months).alias("tenure"), F.col("province").alias("cus_province"),
        *[c for c in months.columns if c.startswith("lifetime_")], F.coalesce("lifetime_days_active", F.lit(0)).alias("lifetime_days_active"),
        F.coalesce("lifetime_pct_complaint_per_item", F.lit(0.0)).alias("lifetime_pct_complaint_per_item"), used.alias("lifetime_service_types_count"),
        dominant.alias("lifetime_dominant_service"), F.coalesce("most_common_rec_province", F.lit(0)).alias("most_common_rec_province"),
        F.coalesce("most_common_region", F.lit("N/A")).alias("most_common_region"),
    )
