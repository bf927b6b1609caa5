"""Exploratory and statistical queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_sql
from ..functions.numeric import rounded
from ..operators import profile, relational as rel, resample, stats
from . import standins as si
from .registry import query
from .tables import Tables


def six(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c)) for c in columns})


DESCRIBED = ("year_built", "current")
DESCRIBE_SQL = " union all ".join(f"""
    select '{c}' as column, count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
           min({c})::double as min, round(quantile_cont({c}, 0.25), 6)::double as p25,
           round(quantile_cont({c}, 0.5), 6)::double as p50, round(quantile_cont({c}, 0.75), 6)::double as p75,
           max({c})::double as max from properties""" for c in DESCRIBED)


@query("describe", DESCRIBE_SQL, ("properties",))
def describe(t: Tables) -> DataFrame:
    return six(profile.describe(si.properties(t), DESCRIBED), "mean", "std", "p25", "p50", "p75")


@query("missing_pct", " union all ".join(
    f"select '{c}' as column, round(avg(case when {c} is null then 1 else 0 end) * 100, 2) as missing_pct from properties"
    for c in ("pid", "year_built", "current", "legal_type", "postcode")), ("properties",))
def missing_pct(t: Tables) -> DataFrame:
    return profile.missing_pct(si.properties(t), ["pid", "year_built", "current", "legal_type", "postcode"])


PROFILED = ("club", "position", "body_type", "attack_rate", "age")


@query("column_profile", " union all ".join(
    f"select '{c}' as column, {c} as value, count(*) as n from players group by {c}" for c in PROFILED), ("players",))
def column_profile(t: Tables) -> DataFrame:
    return profile.value_counts(si.players(t), PROFILED)


@query("head_rows", "select pid, year_built, current from properties order by pid limit 5", ("properties",))
def head_rows(t: Tables) -> DataFrame:
    return rel.head_rows(si.properties(t).select("pid", "year_built", "current"), ["pid"], 5)


@query("eda_year_counts", """
    select year_built, count(*) as n from properties where year_built between 1990 and 2018 group by 1""", ("properties",))
def eda_year_counts(t: Tables) -> DataFrame:
    return profile.year_counts(si.properties(t), "year_built", 1990, 2018)


@query("eda_busy_years", """
    select year_built, count(*) as n from properties where year_built > 1900 and year_built < 2018
    group by 1 having count(*) > 112""", ("properties",))
def eda_busy_years(t: Tables) -> DataFrame:
    return profile.busy(profile.year_counts(si.properties(t), "year_built", 1900, 2018, inclusive=False), 112)


@query("eda_top_years", """
    select year_built, count(*) as n from properties where year_built between 1900 and 2018 group by 1
    order by n desc, year_built limit 20""", ("properties",))
def eda_top_years(t: Tables) -> DataFrame:
    return rel.top_k(profile.year_counts(si.properties(t), "year_built", 1900, 2018), "n", "year_built", 20)


@query("histogram", """
    , counts as (select year_built, count(*)::double as n from properties where year_built > 1890 and year_built < 2018 group by 1),
    ends as (select min(n) as lo, max(n) as hi from counts),
    binned as (select least(60, floor((n - lo) / ((hi - lo) / 60)) + 1)::integer as bin from counts, ends)
    select b.bin::integer as bin, round(lo + (hi - lo) / 60 * (b.bin - 1), 6) as lo, round(lo + (hi - lo) / 60 * b.bin, 6) as hi,
           (select count(*) from binned where binned.bin = b.bin) as n
    from ends, range(1, 61) as b(bin)""", ("properties",))
def histogram(t: Tables) -> DataFrame:
    counts = profile.year_counts(si.properties(t), "year_built", 1890, 2018, inclusive=False)
    return six(profile.histogram(counts, "n", 60), "lo", "hi")


@query("bin2d", """
    , ends as (select min(year_built)::double as x0, max(year_built)::double as x1, min(current) as y0, max(current) as y1
               from properties where year_built is not null)
    select least(20, floor((year_built::double - x0) / ((x1 - x0) / 20)) + 1)::integer as bx,
           least(10, floor((current - y0) / ((y1 - y0) / 10)) + 1)::integer as by, count(*) as n
    from properties, ends where year_built is not null group by 1, 2""", ("properties",))
def bin2d(t: Tables) -> DataFrame:
    return profile.bin2d(si.properties(t), "year_built", "current", 20, 10)


PERCENTILES_SQL = """
    select year_built, quantile_cont(current, 0.25) as p25, quantile_cont(current, 0.5) as p50, quantile_cont(current, 0.75) as p75
    from properties where year_built >= 1900 group by 1"""


def percentiles(t: Tables) -> DataFrame:
    built = si.properties(t).where(F.col("year_built") >= 1900)
    return profile.group_percentiles(built, "year_built", "current")


@query("price_percentiles", f"""
    select year_built, round(p25, 6) as p25, round(p50, 6) as p50, round(p75, 6) as p75 from ({PERCENTILES_SQL})""", ("properties",))
def price_percentiles(t: Tables) -> DataFrame:
    return six(percentiles(t), "p25", "p50", "p75")


@query("price_median", "select 'current' as column, round(median(current), 6) as median from properties", ("properties",))
def price_median(t: Tables) -> DataFrame:
    return six(profile.median(si.properties(t), ["current"]), "median")


@query("pearson", " union all ".join(
    f"select '{p}' as percentile, round(corr(year_built, {p}), 6) as r from ({PERCENTILES_SQL})" for p in ("p25", "p50", "p75")
), ("properties",))
def pearson(t: Tables) -> DataFrame:
    row = percentiles(t).agg(*[stats.pearson("year_built", p).alias(p) for p in ("p25", "p50", "p75")])
    return six(profile.unpivot(row, ["p25", "p50", "p75"], "double").toDF("percentile", "r"), "r")


@query("spearman", f"""
    , points as ({PERCENTILES_SQL}),
    ranked as (select {", ".join(f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0::double as r_{c}"
                                 for c in ("year_built", "p25", "p50", "p75"))} from points)
    """ + " union all ".join(f"select '{p}' as percentile, round(corr(r_year_built, r_{p}), 6) as r from ranked"
                               for p in ("p25", "p50", "p75")), ("properties",))
def spearman(t: Tables) -> DataFrame:
    found = stats.spearman(percentiles(t), "year_built", ["p25", "p50", "p75"])
    return six(found.withColumnRenamed("column", "percentile"), "r")


@query("spearman_rows", """
    , ranked as (select rank() over (order by year_built) + (count(*) over (partition by year_built) - 1) / 2.0::double as a,
                        rank() over (order by current) + (count(*) over (partition by current) - 1) / 2.0::double as b
                 from properties where year_built is not null)
    select round(corr(a, b), 6) as r from ranked""", ("properties",))
def spearman_rows(t: Tables) -> DataFrame:
    return six(stats.spearman(si.properties(t), "year_built", ["current"]).select("r"), "r")


@query("corr_matrix", " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr(try_cast({a} as double), try_cast({b} as double)), 2) as r from players"
    for a in si.SKILLS for b in si.SKILLS), ("players",))
def corr_matrix(t: Tables) -> DataFrame:
    return stats.corr_matrix(rel.cast_columns(si.players(t), si.SKILLS), si.SKILLS)


@query("log_correlation", """
    select count(*) as n, round(corr(n_requests, sum_bytes), 6) as r, round(corr(n_requests, sum_bytes) ** 2, 6) as r2
    from (select count(*) as n_requests, sum(bytes)::bigint as sum_bytes from access_log group by host)""", ("access_log",))
def log_correlation(t: Tables) -> DataFrame:
    hosts = rel.requests_per_host(rel.parse_access_log(si.log_lines(t)))
    return six(stats.correlate(hosts, "n_requests", "sum_bytes"), "r", "r2")


@query("ab_difference", """
    select round(a, 6) as mean_a, round(b, 6) as mean_b, round(abs(a - b), 6) as difference
    from (select avg(search_count) filter (search_ui = 'A') as a, avg(search_count) filter (search_ui = 'B') as b
          from search_log)""", ("search_log",))
def ab_difference(t: Tables) -> DataFrame:
    return six(stats.mean_difference(si.search_log(t), "search_ui", "search_count"), "mean_a", "mean_b", "difference")


@query("crosstab", """
    select is_instructor, search_ui, count(*) as n, 0 as level from search_log group by all
    union all select is_instructor, null, count(*), 1 from search_log group by is_instructor
    union all select null, search_ui, count(*), 2 from search_log group by search_ui
    union all select null, null, count(*), 3 from search_log""", ("search_log",))
def crosstab(t: Tables) -> DataFrame:
    return profile.crosstab(si.search_log(t), "is_instructor", "search_ui")


@query("chi_squared", """
    , r as (select is_instructor, count(*) as r from search_log group by 1),
    c as (select search_ui, count(*) as c from search_log group by 1),
    e as (select is_instructor, search_ui, r * c / (select count(*) from search_log)::double as e from r, c),
    o as (select is_instructor, search_ui, count(*) as o from search_log group by 1, 2)
    select round(sum((coalesce(o, 0) - e) ** 2 / e), 6) as chi2,
           ((select count(*) from r) - 1) * ((select count(*) from c) - 1) as dof
    from e left join o using (is_instructor, search_ui)""", ("search_log",))
def chi_squared(t: Tables) -> DataFrame:
    return six(stats.chi_squared(si.search_log(t), "is_instructor", "search_ui"), "chi2")


def uniform_sql(*parts: str) -> str:
    return f"(({hash_sql(*parts)} >> 8)::double / (1::bigint << 52))"


def gamma_sql(part: str, shape: str) -> str:
    """First accepted of 32 tries a replicate, as (rep, g)."""
    u = lambda k: uniform_sql("'7'", f"'{part}{k}'", "rep", "j")
    return f"""
        select rep, arg_min(v, j) * any_value(d) as g
        from (select rep, j, d, x, w, power(x * c + 1, 3) as v
              from (select rep, j, shape - 1.0::double / 3 as d, 1 / sqrt(9 * (shape - 1.0::double / 3)) as c,
                           sqrt(-2 * ln(1 - {u(1)})) * cos({u(2)} * 2 * pi()) as x, 1 - {u(3)} as w
                    from range({REPLICATES}) r(rep), range(32) t(j), (select {shape} as shape from n)))
        where v > 0 and ln(w) < x * x * 0.5 + d - v * d + ln(v) * d group by rep"""


REPLICATES, PERMUTATIONS = 1000, 10_000


@query("bootstrap_median", f"""
    , numbered as (select current, row_number() over (order by current, pid) - 1 as position from properties),
    n as (select count(*)::double as n, floor((count(*) - 1) * 0.5::double) + 1 as k, (count(*) - 1) * 0.5::double - floor((count(*) - 1) * 0.5::double) as f from properties),
    a as ({gamma_sql("a", "k")}), b as ({gamma_sql("b", "n - k + 1")}),
    first as (select rep, a.g / (a.g + b.g) as u from a join b using (rep)),
    places as (select rep, f, least(n - 1, floor(u * n))::bigint as lo,
                    case when k < n then least(n - 1, floor((1 - (1 - u) * power(1 - {uniform_sql("'7'", "'next'", "rep")}, 1 / (n - k))) * n))::bigint else least(n - 1, floor(u * n))::bigint end as hi
             from first, n),
    stats as (select rep, l.current + (h.current - l.current) * f as stat from places join numbered l on l.position = lo join numbered h on h.position = hi),
    observed as (select median(current) as o from properties)
    select round(o, 6) as stat, round(o - quantile_cont(stat - o, 0.975), 6) as lo, round(o - quantile_cont(stat - o, 0.025), 6) as hi
    from stats, observed group by o""", ("properties",))
def bootstrap_median(t: Tables) -> DataFrame:
    return six(resample.bootstrap_ci(si.properties(t), "current", reps=REPLICATES, seed=7), "stat", "lo", "hi")


def log_factorial_sql(x: str) -> str:
    z, s = f"({x} + 1)", f"({x} + 9)"
    product = " * ".join([z, *[f"({x} + {i})" for i in range(2, 9)]])
    return (f"(({s} - 0.5) * ln({s}) - {s} + 0.9189385332046727 + 1 / ({s} * 12) - 1 / ({s} ** 3 * 360) + 1 / ({s} ** 5 * 1260) "
            f"- 1 / ({s} ** 7 * 1680) - ln({product}))")


def log_choose_sql(n: str, k: str) -> str:
    return f"({log_factorial_sql(n)} - {log_factorial_sql(k)} - {log_factorial_sql(f'({n} - {k})')})"


def split_sql(h: int) -> str:
    """Level ``h`` of the value tree split into level ``h - 1``: rows (rep, j, c)."""
    log_f = lambda x: f"({log_choose_sql('k', x)} + {log_choose_sql('(n - k)', f'(c - {x})')})"
    # a list of one value, so that a try's numbers are computed once
    bits = lambda at: f"('0x' || substr(d, {at}, 13))::bigint::double / (1::bigint << 52)"
    x = f"list_transform(list_transform([md5(concat_ws('-', '7', rep, {h}, j, t::bigint))], lambda d: [1 - {bits(1)}, 2 * ({bits(14)}) - 1]), lambda p: [floor(m + p[2] / (p[1] * f)), p[1]])[1]"
    hit = f"list_transform([{x}], lambda q: case when q[1] >= lo and q[1] <= hi then case when {log_f('q[1]')} - top >= 2 * ln(q[2]) then q[1] end end)[1]"
    found = f"list_reduce(list_concat([-1::double], list_transform(range(256), lambda i: i::double)), lambda a, t: case when a >= 0 then a else coalesce({hit}, -1) end)"
    return f"""
    s{h} as (select i >> {h} as j, sum(n)::double as n, sum(n) filter (((i >> {h - 1}) & 1) = 0)::double as k from counts group by 1),
    m{h} as materialized (select *, {log_f('m')} as top, exp({log_f('m')} - {log_choose_sql('n', 'c')}) as f from (
        select *, greatest(lo, least(hi, floor((c + 1) * (k + 1) / (n + 2)))) as m from (
            select rep, j, c, n, k, greatest(0, c - (n - k))::double as lo, least(c, k) as hi from l{h} join s{h} using (j)))),
    g{h} as materialized (select rep, j, c, case when lo = hi then lo else {found} end as got from m{h}),
    l{h - 1} as (select rep, 2 * j as j, got as c from g{h} where got > 0 union all select rep, 2 * j + 1, c - got from g{h} where c > got)"""


VALUE_LEVELS = 6  # of the checking SQL: up to 64 distinct values


@query("permutation_test", f"""
    , size as (select count(*) filter (search_ui = 'A') as na, count(*) filter (search_ui = 'B') as nb,
                      sum(search_count)::double as total, sum(search_count) filter (search_ui = 'A')::double as sa from search_log),
    counts as materialized (select v, n, row_number() over (order by v) - 1 as i from (select search_count as v, count(*) as n from search_log group by 1)),
    l{VALUE_LEVELS} as (select rep, 0::bigint as j, na::double as c from range({PERMUTATIONS}) r(rep), size),
    {", ".join(split_sql(h) for h in range(VALUE_LEVELS, 0, -1))},
    sums as (select rep, sum(c * v)::double as s from l0 join counts on i = j group by rep),
    spread as (select abs(s * nb - (total - s) * na) as d, abs(sa * nb - (total - sa) * na) as o, na, nb from sums, size)
    select round(any_value(o / na / nb), 6) as observed, count(*) filter (d > o) as n_above, count(*) filter (d > o) / {PERMUTATIONS}::double as p_value
    from spread""", ("search_log",))
def permutation_test(t: Tables) -> DataFrame:
    return six(resample.permutation_test(si.search_log(t), "search_ui", "search_count", reps=PERMUTATIONS, seed=7), "observed")


@query("train_split", f"""
    select o_orderkey, case when ({hash_sql("'3'", "o_orderkey")} >> 8)::double / (1::bigint << 52) < 0.75 then 'train'
                       else 'validation' end as part from orders""")
def train_split(t: Tables) -> DataFrame:
    return resample.hash_split(t.orders.select("o_orderkey"), ["o_orderkey"], 0.75, 3)
