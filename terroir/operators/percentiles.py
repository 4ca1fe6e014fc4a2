"""Exact interpolated percentiles that never hold a large group in one task.

The built-in ``percentile`` keeps every distinct value of a group in one task's map. Here, for every size of input, in
one lazy plan:

1. rows are counted per group and value with map-side combine, so a hot value is one row per map task (a histogram,
   given with its ``weight``, is this step's result already);
2. these counts are dealt by group and slice of the value range, a thousandth of a value wide, and summed per slice;
3. the running sum over the few sums of a group locates the slices that hold the wanted positions;
4. the counts of located slices go on to the built-in ``percentile``, which combines before it shuffles. Each of the two
   values around a wanted position is asked for as a median: a count at minus infinity and one at NaN stand for what
   lies below and above its slice, and put the value exactly in the middle. So it is an element, not interpolated yet.

A trailing window over months (``window``) takes the same steps with windows in the place of groups, and no row is copied to
the windows it belongs to: per slice, a month's count is added from that month on and taken off again when the window
has passed it, so a running sum gives every window's count as the difference of two prefixes. Only counts of located
slices then meet the windows that they were located for.

That is four shuffles with the one that counts, and one more where the located slices are too many to broadcast. A hot group spreads over its values and slices; one task gets a slice of
it, some thousandth of its distinct values. NaN sorts last and has a slice of its own, as every infinity has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Pct:
    """One wanted percentile: output ``name``, ``value`` column, position ``p`` and slice ``width``.

    ``width`` is the linear slice width in units of the value; without it slices are logarithmic (about 0.1 % wide).
    """

    name: str
    value: str
    p: float = 0.5
    width: float | None = None


def _slice(width: float | None) -> str:
    """The slice of ``x`` as a whole number, which Spark compares as it is; infinities are the outermost ones."""
    inner = "cast(signum(x) as bigint) * floor(log1p(abs(x)) * 1024)" if width is None else f"floor(x / {float(width)!r}D)"
    return f"if(isnan(x), {(1 << 63) - 1}L, {inner})"


#: The counts are read twice, for the sums and for the located slices. Both name the same columns (``least`` is there for
#: that alone) and compare null-safely, which adds no filter, so Spark deals the counts once and reuses the exchange.
_PLAN = """
with stacked as (
  select * from (select {all}{rows} as w, inline(array({entries})) from {{df}}) where x is not null
),
counted as ({counted}),
dealt as (
  select /*+ repartition({k}m, s) */ * from (select {all}m, case m {slices} end as s, x, n from counted)
),
{sums}
placed as (
  select {g}m, s, c, least, sum(c) over (partition by {g}m) as total,
         sum(c) over (partition by {g}m order by s rows unbounded preceding) - c as before
  from slices
),
located as (
  select * from (select *, {wanted} as wanted from placed) where wanted <> 0 and least is not null
),
held as (
  {met}
  union all
  select {g}m, inline(filter(array({ends}), e -> e.n > 0 and e.wanted & wanted <> 0)) from located
)
select {results} from held {grouped}"""

_SUMS = """slices as (
  select {k}m, s, sum(n) as c, min(x) as least from dealt group by {k}m, s
),"""

#: The sums of a level are those of the finest groups, added up; counts of values are not copied to the levels.
_LEVEL_SUMS = """finest as (
  select {k}m, s, sum(n) as c, min(x) as least from dealt group by {k}m, s
),
slices as (
  select {g}m, s, sum(c) as c, min(least) as least
  from (select m, s, c, least, inline(array({levels})) from finest) group by {g}m, s
),"""

#: A count enters in its month and leaves ``months`` later; between two events of a slice the window's count stays.
_WINDOW_SUMS = """monthly as (
  select {k}m, s, {month}, sum(n) as c, min(x) as least from dealt group by {k}m, s, {month}
),
events as (
  select {k}m, s, t, sum(e) as e, min(least) as least
  from (select {k}m, s, least, inline(array(struct({month} as t, c as e), struct(add_months({month}, {months}) as t, -c as e)))
        from monthly)
  group by {k}m, s, t
),
steps as (
  select {k}m, s, t, least, sum(e) over (partition by {k}m, s order by t rows unbounded preceding) as c,
         lead(t) over (partition by {k}m, s order by t) as until
  from events
),
slices as (
  select {k}explode(sequence(t, add_months(until, -1), interval 1 month)) as {month}, m, s, c, least from steps where c > 0
),"""


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    wanted: Sequence[Pct],
    weight: str | None = None,
    counts: Mapping[str, str] | None = None,
    window: tuple[str, int] | None = None,
    levels: tuple[str, Mapping[str, Sequence[str]]] | None = None,
) -> DataFrame:
    """Keys and one double column per ``wanted``; groups without any non-NULL value are absent.

    Without ``keys``, all rows are one group. ``weight`` names a column of row counts when ``df`` is already a
    histogram. ``counts`` adds the number of non-NULL values of a value column under a given name (it is known anyway).

    ``window`` names one of ``keys``, a first day of a month, and a number of months: rows of that many months up to a month
    are the group of that month, from the first month with rows on until no row is left, months without rows included.

    ``levels`` adds a column of that name before the keys and gives, for each level, the groups of those of the keys that
    the level names; the other keys are NULL there. Not together with ``window``.
    """
    widths: dict[str, float | None] = {}
    for w in wanted:
        widths.setdefault(w.value, w.width)
    values = list(widths)

    bits, ends, results = [], [], [f"`{c}`" for c in keys]
    for i, w in enumerate(wanted):
        m, position = values.index(w.value), f"((total - 1) * {float(w.p)!r}D)"
        found = []
        for j, bound in enumerate((f"floor({position})", f"ceil({position})")):
            bit = 1 << 2 * i + j
            bits.append(f"if(m = {m} and {bound} >= before and {bound} < before + c, {bit}L, 0L)")
            for end, n in (
                ("-infinity", f"before + greatest(0L, total - 1 - 2 * {bound})"),
                ("NaN", f"total - before - c + greatest(0L, 2 * {bound} - total + 1)"),
            ):
                ends.append(f"struct(double('{end}') as x, {n} as n, total, {bit}L as wanted)")
            mine = f"m = {m} and wanted & {bit}L <> 0"
            found.append(f"percentile(if({mine}, x, null), 0.5D, if({mine}, n, 0L))")
        position = position.replace("total", f"max(if(m = {m}, total, null))")
        above, (low, high) = f"({position} - floor({position}))", found
        results.append(f"if({above} = 0, {low}, {low} * (1D - {above}) + {high} * {above}) as `{w.name}`")
    for name, value in (counts or {}).items():
        results.append(f"coalesce(max(if(m = {values.index(value)}, total, null)), 0L) as `{name}`")

    if window and levels:
        raise ValueError("window and levels don't go together")
    month, months = window or (None, 0)
    level, members = levels or (None, {})
    own = [c for c in keys if c != month]
    every = [*own, *([month] if month else [])]
    result = [*([level] if level else []), *every]
    if level:
        results.insert(0, f"`{level}`")

    def listed(columns: Sequence[str], prefix: str = "") -> str:
        return "".join(f"{prefix}`{c}`, " for c in columns)

    def met(columns: Sequence[str], located: str) -> str:
        same = [*(f"h.`{c}` <=> t.`{c}`" for c in columns), "h.m <=> t.m", "h.s <=> t.s"]
        if month:
            same.append(f"coalesce(h.`{month}` between add_months(t.`{month}`, {1 - months}) and t.`{month}`, false)")
        return f"select {listed(result, 't.')}h.m, h.x, h.n, t.total, t.wanted from dealt h join {located} t on {' and '.join(same)}"

    if level:
        rows = [
            ", ".join([f"'{name}' as `{level}`", *(f"if({str(c in kept).lower()}, `{c}`, null) as `{c}`" for c in own)])
            for name, kept in members.items()
        ]
        sums = _LEVEL_SUMS.format(k=listed(own), g=listed(result), levels=", ".join(f"struct({row})" for row in rows))
        # Naming the count keeps the condition above the windows, whose exchange all levels then share.
        joins = [met(kept, f"(select * from located where if(c > 0, `{level}`, null) = '{name}')") for name, kept in members.items()]
    else:
        sums = _WINDOW_SUMS.format(k=listed(own), month=f"`{month}`", months=months) if month else _SUMS.format(k=listed(own))
        joins = [met(own, "located")]
    text = _PLAN.format(
        k=listed(own),
        all=listed(every),
        g=listed(result),
        # Without keys there is no row for no values.
        grouped=f"group by {', '.join(f'`{c}`' for c in result)}" if result else "having count(*) > 0",
        rows="1L" if weight is None else f"cast(`{weight}` as bigint)",
        entries=", ".join(f"struct({i} as m, cast(`{v}` as double) as x)" for i, v in enumerate(values)),
        counted=f"select {listed(every)}m, x, sum(w) as n from stacked group by {listed(every)}m, x" if weight is None
        else f"select {listed(every)}m, x, w as n from stacked",
        slices=" ".join(f"when {i} then {_slice(widths[v])}" for i, v in enumerate(values)),
        sums=sums,
        met="\n  union all\n  ".join(joins),
        wanted=" | ".join(bits),
        ends=", ".join(ends),
        results=", ".join(results),
    )
    return df.sparkSession.sql(text, df=df)
