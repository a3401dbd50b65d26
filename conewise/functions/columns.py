"""Column builders (the P and F rows of the inventory).

All are compositions of ``pyspark.sql.functions``: they stay inside
whole-stage codegen and fold constants in Catalyst.  Money is kept as
DECIMAL until the last step so sums do not depend on row order, and rounding
is HALF_UP on exact values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from conewise.functions import rules as R

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- predicates

def flag(cond: Column) -> Column:
    """Condition -> 1/0 integer flag (null condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def decode(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Simple CASE with a default."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def normalise(c: ColumnOrName, mapping: Mapping[str, str], default: str) -> Column:
    """Lookup of lower(trim(x)) in a literal map; unknown and null -> default."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, F.lower(F.trim(col(c)))), F.lit(default))


def _like_any(c: Column, patterns: Sequence) -> Column:
    cond = None
    for p in patterns:
        if isinstance(p, tuple) and p[0] == "exact":
            term = c.like(p[1])  # as typed, no lower()
        else:
            term = F.lower(c).like(p)
        cond = term if cond is None else (cond | term)
    return cond


def first_match(c: ColumnOrName, rules: Sequence, default) -> Column:
    """Ordered LIKE ladder, first matching rule wins."""
    c = col(c)
    out = None
    for patterns, value in rules:
        cond = _like_any(c, patterns)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))


def weight_kg(name: ColumnOrName) -> Column:
    """Product weight from its name, as DECIMAL(4,2)."""
    rules = [(p, v) for p, v in R.WEIGHT_LADDER]
    return first_match(name, rules, R.WEIGHT_DEFAULT).cast("decimal(4,2)")


def tier(c: ColumnOrName, bounds: Sequence[tuple[float, float]], default,
         exclude: tuple[ColumnOrName, Sequence[str]] | None = None, excluded_value=0) -> Column:
    """Ordered numeric tiers (x <= bound -> value), optional name exclusions first."""
    c = col(c)
    out = None
    if exclude is not None:
        name, patterns = exclude
        out = F.when(_like_any(col(name), patterns), F.lit(excluded_value))
    for bound, value in bounds:
        cond = c <= F.lit(bound)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))


def classify_sign(c: ColumnOrName, pos="acumulacion", neg="canje", zero="sin_movimiento") -> Column:
    """>0 / <0 / else label."""
    c = col(c)
    return F.when(c > 0, F.lit(pos)).when(c < 0, F.lit(neg)).otherwise(F.lit(zero))


def bands_le(c: ColumnOrName, bands, default) -> Column:
    """X <= bound -> score, first match."""
    c = col(c)
    out = None
    for bound, score in bands:
        out = F.when(c <= bound, F.lit(score)) if out is None else out.when(c <= bound, F.lit(score))
    return out.otherwise(F.lit(default))


def bands_ge(c: ColumnOrName, bands, default) -> Column:
    """P10: x >= bound -> score, first match."""
    c = col(c)
    out = None
    for bound, score in bands:
        out = F.when(c >= bound, F.lit(score)) if out is None else out.when(c >= bound, F.lit(score))
    return out.otherwise(F.lit(default))


def recency_score(days: ColumnOrName) -> Column:
    return bands_le(days, R.RECENCY_BANDS, R.RECENCY_DEFAULT)


def frequency_score(per_week: ColumnOrName) -> Column:
    return bands_ge(per_week, R.FREQUENCY_BANDS, R.FREQUENCY_DEFAULT)


def month_in(month: ColumnOrName, table, default=None) -> Column:
    """Month number -> label through a (label, months) table."""
    m = col(month)
    out = None
    for label, months in table:
        cond = m.isin(months)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def season(month: ColumnOrName) -> Column:
    """Southern-hemisphere season."""
    return month_in(month, R.SEASONS)


def commercial_season(month: ColumnOrName, table=R.COMMERCIAL_SEASON_ORDERS) -> Column:
    """Alta / Media / Baja; pass the cohort table for cohort reports."""
    return month_in(month, table, R.COMMERCIAL_SEASON_DEFAULT)


def daypart(hour: ColumnOrName) -> Column:
    """Hour -> Mediodia / Tarde / Noche / Trasnoche / Otro."""
    h = col(hour)
    out = None
    for label, lo, hi in R.DAYPARTS:
        cond = h.between(lo, hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(R.DAYPART_DEFAULT))


def segment(total_orders, days, r, f, m) -> Column:
    """Ordered customer segments, first match wins (``rules.SEGMENT_RULES``)."""
    value = {"orders": col(total_orders), "days": col(days), "r": col(r), "f": col(f), "m": col(m)}
    out = F.when(F.coalesce(value["orders"], F.lit(0)) == 0, F.lit(R.SEGMENT_NO_PURCHASE))
    for label, limits in R.SEGMENT_RULES:
        cond = F.lit(True)
        for name, side, bound in limits:
            cond = cond & (value[name] <= bound if side == "<=" else value[name] >= bound)
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(R.SEGMENT_DEFAULT))


def preferred_of_three(a: ColumnOrName, b: ColumnOrName, c: ColumnOrName,
                       labels: Sequence[str]) -> Column:
    """Argmax of three counters, ties go to the earlier one (nulls = 0)."""
    a, b, c = (F.coalesce(col(x), F.lit(0)) for x in (a, b, c))
    return (F.when((a >= b) & (a >= c), F.lit(labels[0]))
            .when(b >= c, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def argmax_label(cols: Sequence[ColumnOrName], labels: Sequence[str]) -> Column:
    """Label of the greatest value, first wins (``case greatest(..) when ..``)."""
    cs = [col(x) for x in cols]
    g = F.greatest(*cs)
    out = None
    for c, label in zip(cs, labels):
        out = F.when(g == c, F.lit(label)) if out is None else out.when(g == c, F.lit(label))
    return out


def score_label(score: ColumnOrName, labels: Mapping[int, str], default=R.NO_PURCHASE_LABEL) -> Column:
    """Score -> text."""
    return decode(score, labels, default)


def coalesce_from(sources: Sequence[tuple[str, ColumnOrName]]) -> tuple[Column, Column]:
    """First non-null value and the name of the source that gave it."""
    cols = [col(c) for _, c in sources]
    value = F.coalesce(*cols)
    origin = None
    for (name, _), c in zip(sources, cols):
        cond = c.isNotNull()
        origin = F.when(cond, F.lit(name)) if origin is None else origin.when(cond, F.lit(name))
    return value, origin


def not_blank(c: ColumnOrName) -> Column:
    """Not null and not only spaces."""
    c = col(c)
    return c.isNotNull() & (F.trim(c) != F.lit(""))


def ddiv(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Exact decimal division keeping 12 decimals (null when y is 0).

    Spark sizes a decimal quotient from the operand precisions and, past 38
    digits, cuts its scale down to 6, which would round twice.  The operands are
    sized first: amounts up to 10**22 and divisors up to 10**28 keep 12 decimals.
    """
    return F.try_divide(col(x).cast("decimal(32,10)"), col(y).cast("decimal(32,4)"))


def pct(x: ColumnOrName, y: ColumnOrName, digits: int = 1, default=0) -> Column:
    """``round(100.0 * x / y, digits)`` when y > 0 else default."""
    from decimal import Decimal
    x, y = col(x), col(y)
    val = F.round(ddiv(x * F.lit(Decimal("100.0")), y), digits)
    return F.when(y > 0, val).otherwise(F.lit(default))


def to_usd(amount: ColumnOrName, rate: ColumnOrName, digits: int = 2) -> Column:
    """Amount / rate rounded; null when there is no rate or it is 0."""
    rate = col(rate)
    return F.round(ddiv(col(amount), F.nullif(rate, F.lit(0))), digits)


# ---------------------------------------------------------------- calendar

def epoch_to_ts(seconds: ColumnOrName, tz: str | None = None) -> Column:
    """Unix seconds -> TIMESTAMP_NTZ (wall clock in ``tz``, UTC when None).

    Independent of the session time zone, so marts do not shift when the
    cluster default does.
    """
    ts = F.timestamp_add("SECOND", col(seconds), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if tz and tz.upper() != "UTC":
        ts = F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)
    return ts


def week_start(d: ColumnOrName) -> Column:
    """Monday of the week, as DATE."""
    return F.trunc(F.to_date(col(d)), "week")


def month_start(d: ColumnOrName) -> Column:
    """first of the month, as DATE."""
    return F.trunc(F.to_date(col(d)), "month")


def day_of_week_sun0(d: ColumnOrName) -> Column:
    """day of week with Sunday = 0."""
    return F.dayofweek(col(d)) - 1


def year_month(d: ColumnOrName) -> Column:
    """'YYYY-MM' text."""
    return F.date_format(col(d), "yyyy-MM")


def month_from_text(ym: ColumnOrName) -> Column:
    """'YYYY-MM' -> first-of-month DATE (null when not a month)."""
    return F.try_to_date(F.concat(col(ym), F.lit("-01")), "yyyy-MM-dd") if hasattr(F, "try_to_date") \
        else F.to_date(F.concat(col(ym), F.lit("-01")))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """whole days from start to end (dates)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def weeks_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """complete 7-day weeks from start to end (floor(days / 7))."""
    return F.floor(days_between(start, end) / 7).cast("bigint")


def plus_days(ts: ColumnOrName, n: int) -> Column:
    """timestamp + n days."""
    return col(ts) + F.make_dt_interval(days=F.lit(n))


def date_spine(lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """inclusive daily series (array to explode)."""
    return F.sequence(F.to_date(col(lo)), F.to_date(col(hi)), F.expr("INTERVAL 1 DAY"))


# ---------------------------------------------------------------- text / display

def money_text(c: ColumnOrName, prefix: str = "$") -> Column:
    """compact money text: 1.2M / 3.4K / 950, '<prefix>0' for 0 or null."""
    v = col(c).cast("double")
    a = F.abs(v)
    return (
        F.when(v.isNull() | (v == 0), F.lit(prefix + "0"))
        .when(a >= 1_000_000, F.concat(F.lit(prefix), F.format_number(v / 1_000_000, 1), F.lit("M")))
        .when(a >= 1_000, F.concat(F.lit(prefix), F.format_number(v / 1_000, 1), F.lit("K")))
        .otherwise(F.concat(F.lit(prefix), F.format_number(v, 0)))
    )


def pct_text(c: ColumnOrName) -> Column:
    """'12.3%', dash for null."""
    v = col(c).cast("double")
    return F.when(v.isNull(), F.lit("—")).otherwise(F.concat(F.format_string("%.1f", v), F.lit("%")))


def label_map(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """code -> display label, unknown codes kept."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, col(c)), col(c))


def order_rank(c: ColumnOrName, labels: Iterable[str]) -> Column:
    """Position of a label in a declared order (unknown -> after all)."""
    labels = list(labels)
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), col(c))
    return F.when(pos > 0, pos).otherwise(F.lit(len(labels) + 1))
