"""Similarity joins, matching, treatment effects and the streamed line."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rounded
from ..operators import causal, entity, simjoin
from ..operators.relational import evaluate_pairs
from ..operators.skew import widen
from ..session import cut_lineage
from ..sources.readers import read_stream
from ..streaming import regression
from . import standins as si
from .registry import query
from .tables import Tables


def sets_sql(table: str, id: str) -> str:
    tokens = r"list_sort(list_filter(list_distinct(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+')), lambda x: x <> ''))"
    return f"""select min({id}) as set_id, count(*) as copies, tokens, len(tokens) as size
               from (select {id}, {tokens} as tokens from {table}) where len(tokens) > 0 group by tokens"""


def links_sql(threshold: float) -> str:
    return f"""
    with sets as materialized ({sets_sql("documents", "doc_id")}),
    t as materialized (select set_id, copies, size, unnest(tokens) as token from sets),
    shared as (select a.set_id as id1, b.set_id as id2, any_value(a.size) as n1, any_value(b.size) as n2,
                      any_value(a.copies * b.copies) as n_pairs, count(*) as i
               from t a join t b on a.token = b.token and a.set_id < b.set_id
               group by a.set_id, b.set_id),
    links as materialized (
        select id1, id2, i / (n1 + n2 - i)::double as jaccard, n_pairs from shared where i / (n1 + n2 - i)::double >= {threshold}
        union all select set_id, set_id, 1.0::double, copies * (copies - 1) // 2 from sets where copies > 1)"""


def links(t: Tables, threshold: float) -> DataFrame:
    return simjoin.jaccard_self_join(widen(t.documents.select("doc_id", "text")), "doc_id", ["text"], threshold)


@query("jaccard_self", links_sql(0.8) + "select id1, id2, round(jaccard, 6) as jaccard, n_pairs from links")
def jaccard_self(t: Tables) -> DataFrame:
    return links(t, 0.8).withColumn("jaccard", rounded(F.col("jaccard")))


@query("jaccard_join", f"""
    with l as materialized ({sets_sql("documents", "doc_id")}), r as materialized ({sets_sql("benchmark", "item_id")}),
    lt as (select set_id, copies, size, unnest(tokens) as token from l),
    rt as (select set_id, copies, size, unnest(tokens) as token from r),
    shared as (select a.set_id as id1, b.set_id as id2, any_value(a.size) as n1, any_value(b.size) as n2,
                      any_value(a.copies * b.copies) as n_pairs, count(*) as i
               from lt a join rt b on a.token = b.token group by a.set_id, b.set_id)
    select id1, id2, round(i / (n1 + n2 - i)::double, 6) as jaccard, n_pairs from shared
    where i / (n1 + n2 - i)::double >= 0.3""")
def jaccard_join(t: Tables) -> DataFrame:
    found = simjoin.jaccard_join(widen(t.documents.select("doc_id", "text")), t.benchmark, "doc_id", "item_id", ["text"], ["text"], 0.3)
    return found.withColumn("jaccard", rounded(F.col("jaccard")))


@query("token_sets", f"""
    with sets as ({sets_sql("documents", "doc_id")}),
    m as (select doc_id, list_sort(list_filter(list_distinct(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}_]+')), lambda x: x <> '')) as tokens
          from documents)
    select doc_id as id, set_id from m join sets using (tokens)""")
def token_sets(t: Tables) -> DataFrame:
    members = cut_lineage(simjoin.token_members(widen(t.documents.select("doc_id", "text")), "doc_id", ["text"]))
    return simjoin.set_membership(members, simjoin.token_sets(members))


@query("match_quality", links_sql(0.5) + """
    , q as (select sum(n_pairs) filter (jaccard >= 0.8)::double / nullif(sum(n_pairs) filter (jaccard >= 0.8), 0) as p,
                   sum(n_pairs) filter (jaccard >= 0.8)::double / nullif(sum(n_pairs), 0) as r from links)
    select round(p, 6) as precision, round(r, 6) as recall, round(2 * p * r / nullif(p + r, 0), 6) as fmeasure from q""")
def match_quality(t: Tables) -> DataFrame:
    truth = cut_lineage(links(t, 0.5))
    quality = evaluate_pairs(truth.where(F.col("jaccard") >= 0.8), truth, weight="n_pairs")
    return quality.select(*[rounded(F.col(c)).alias(c) for c in ("precision", "recall", "fmeasure")])


# from plain record pairs; pairs that look alike are counted together, named by the smallest ids that look so
FEATURES_SQL = links_sql(0.5) + r"""
    , records as (select doc_id, length(text) as n, source, lang, s.set_id,
                         min(doc_id) over (partition by s.set_id, length(text), source, lang) as p
                  from documents join sets s on s.tokens = list_sort(list_filter(list_distinct(
                      regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+')), lambda x: x <> ''))),
    record_pairs as (select least(a.p, b.p) as id1, greatest(a.p, b.p) as id2, jaccard,
                            least(a.n, b.n)::double / greatest(a.n, b.n) as length_ratio,
                            1 - levenshtein(a.source, b.source)::double / greatest(length(a.source), length(b.source)) as source_ratio,
                            cast(a.lang = b.lang as integer) as same_lang
                     from records a join records b on a.doc_id < b.doc_id
                     join links l on l.id1 = least(a.set_id, b.set_id) and l.id2 = greatest(a.set_id, b.set_id)),
    features as (select id1, id2, jaccard, length_ratio, source_ratio, same_lang, count(*) as n_pairs from record_pairs group by all)"""


def features(t: Tables) -> DataFrame:
    members = cut_lineage(simjoin.token_members(t.documents.select("doc_id", "text"), "doc_id", ["text"]))
    owners = simjoin.set_membership(members, simjoin.token_sets(members))
    profiles = cut_lineage(entity.record_profiles(owners, t.documents, "doc_id", "text", "source", "lang"))
    return entity.pair_features(links(t, 0.5), profiles)


@query("pair_features", FEATURES_SQL + """
    select id1, id2, round(jaccard, 6) as jaccard, round(length_ratio, 6) as length_ratio, round(source_ratio, 6) as source_ratio, same_lang, n_pairs
    from features""")
def pair_features(t: Tables) -> DataFrame:
    return features(t).withColumns({c: rounded(F.col(c)) for c in ("jaccard", "length_ratio", "source_ratio")})


@query("seed_pairs", FEATURES_SQL + """
    select id1, id2, n_pairs, cast(jaccard >= 0.8 as integer) as label
    from (select *, row_number() over (order by jaccard desc, id1, id2) as hi, row_number() over (order by jaccard, id1, id2) as lo from features)
    where hi <= 5 or lo <= 5""")
def seed_pairs(t: Tables) -> DataFrame:
    pairs = cut_lineage(features(t))
    return entity.seed_pairs(pairs, pairs.where(F.col("jaccard") >= 0.8), 5).select("id1", "id2", "n_pairs", "label")


@query("active_learning")
def active_learning(t: Tables) -> DataFrame:
    pairs = cut_lineage(features(t))
    truth = pairs.where(F.col("jaccard") >= 0.8)
    model, _ = entity.active_learning(pairs, truth, rounds=3, batch=2)
    return entity.match_quality(model, pairs, truth)


@query("exact_match", """
    , pairs as (select c.id, c.outcome as co, t.outcome as tr, row_number() over (partition by c.id order by t.id) as rn
                from programme c join programme t on c.nation = t.nation and c.n_orders = t.n_orders and floor(c.balance / 2000) = floor(t.balance / 2000) where c.treat = 0 and t.treat = 1)
    select count(*) as n_matched, round(count(*) * 100.0::double / (select count(*) from programme where treat = 0), 6) as pct,
           round(avg(tr - co), 4) as effect from pairs where rn = 1""", ("programme",))
def exact_match(t: Tables) -> DataFrame:
    rows = si.programme(t).withColumn("balance_band", F.floor(F.col("balance") / 2000))  # cents are never alike
    return _rounded_effect(causal.exact_match_effect(rows, "treat", "outcome", ["nation", "n_orders", "balance_band"], "id"))


def _rounded_effect(df: DataFrame) -> DataFrame:
    return df.select("n_matched", rounded(F.col("pct")).alias("pct"), rounded(F.col("effect"), 4).alias("effect"))


@query("nearest_match", """
    , pairs as (select c.id, c.outcome as co, t.outcome as tr, t.id as tid,
                       sqrt((c.nation - t.nation) * (c.nation - t.nation) + (c.n_orders - t.n_orders) * (c.n_orders - t.n_orders)
                            + (c.balance - t.balance) * (c.balance - t.balance)) as d
                from programme c, programme t where c.treat = 0 and t.treat = 1),
    best as (select *, row_number() over (partition by id order by d, tid) as rn from pairs where d < 1000)
    select count(*) as n_matched, round(count(*) * 100.0::double / (select count(*) from programme where treat = 0), 6) as pct,
           round(avg(tr - co), 4) as effect from best where rn = 1""", ("programme",))
def nearest_match(t: Tables) -> DataFrame:
    return _rounded_effect(
        causal.nearest_match_effect(si.programme(t), "treat", "outcome", ["nation", "n_orders", "balance"], "id", 1000.0)
    )


@query("propensity_match", """
    , s as (select *, (abs(balance) + n_orders * 100) / 20000 as score from programme),
    pairs as (select c.id, c.outcome as co, t.outcome as tr, t.id as tid, sqrt((c.score - t.score) * (c.score - t.score)) as d
              from s c, s t where c.treat = 0 and t.treat = 1),
    best as (select *, row_number() over (partition by id order by d, tid) as rn from pairs where d <= 0.01)
    select count(*) as n_matched, round(count(*) * 100.0::double / (select count(*) from programme where treat = 0), 6) as pct,
           round(avg(tr - co), 4) as effect from best where rn = 1""", ("programme",))
def propensity_match(t: Tables) -> DataFrame:
    scored = si.programme(t).withColumn("score", (F.abs("balance") + F.col("n_orders") * 100) / 20000)
    return _rounded_effect(causal.propensity_match_effect(scored, "treat", "outcome", "score", "id", 0.01))


COVARIATES = ["nation", "n_orders", "balance"]


@query("propensity_scores")
def propensity_scores(t: Tables) -> DataFrame:
    return causal.propensity_scores(si.programme(t), "treat", COVARIATES).select("id", "treat", "score")


@query("propensity_effect")
def propensity_effect(t: Tables) -> DataFrame:
    """Fit on all covariates, then match on the fitted score."""
    return causal.propensity_effect(si.programme(t), "treat", "outcome", COVARIATES, "id", 0.01)


@query("confounder_match")
def confounder_match(t: Tables) -> DataFrame:
    """The same with the named confounders only."""
    return causal.propensity_effect(si.programme(t), "treat", "outcome", ["nation", "n_orders"], "id", 0.01)


# Least squares by taking the covariates out of each other in turn; ``g`` names the rows that a model is fitted on.
STEPS_SQL = """
    , m as (select g, avg(nation) as mn, avg(n_orders) as mo, avg(balance) as mb, avg(outcome) as my, avg(treat) as mt from fitted group by g),
    r1 as (select f.g, nation - mn as q1, n_orders - mo as o0, balance - mb as b0, outcome - my as y0, treat - mt as t0 from fitted f join m on f.g = m.g),
    k1 as (select g, sum(o0 * q1) / sum(q1 * q1) as a21, sum(b0 * q1) / sum(q1 * q1) as a31, sum(t0 * q1) / sum(q1 * q1) as t1, sum(y0 * q1) / sum(q1 * q1) as c1 from r1 group by g),
    r2 as (select r1.*, o0 - a21 * q1 as q2 from r1 join k1 using (g)),
    k2 as (select g, sum(b0 * q2) / sum(q2 * q2) as a32, sum(t0 * q2) / sum(q2 * q2) as t2, sum(y0 * q2) / sum(q2 * q2) as c2 from r2 group by g),
    r3 as (select r2.*, b0 - a31 * q1 - a32 * q2 as q3 from r2 join k1 using (g) join k2 using (g)),
    k3 as (select g, sum(t0 * q3) / sum(q3 * q3) as t3, sum(y0 * q3) / sum(q3 * q3) as c3 from r3 group by g)"""


@query("two_model_effect", f"""
    , fitted as (select *, treat as g from programme){STEPS_SQL},
    crossed as (select treat, outcome, nation - mn as q1, n_orders - mo - a21 * (nation - mn) as q2, balance - mb as b0, m.g from programme join m on m.g <> treat join k1 on k1.g = m.g),
    said as (select treat, outcome, my + c1 * q1 + c2 * q2 + c3 * (b0 - a31 * q1 - a32 * q2) as y
             from crossed c join m on m.g = c.g join k1 on k1.g = c.g join k2 on k2.g = c.g join k3 on k3.g = c.g)
    select count(*) as n, round(avg(case when treat = 1 then outcome - y else y - outcome end), 2) as effect from said""", ("programme",))
def two_model_effect(t: Tables) -> DataFrame:
    found = causal.two_model_effect(si.programme(t), "treat", "outcome", COVARIATES)
    return found.withColumn("effect", rounded(F.col("effect"), 2))


@query("adjusted_effect", f"""
    , fitted as (select *, 1 as g from programme){STEPS_SQL},
    alone as (select y0, t0 - t1 * q1 - t2 * q2 - t3 * q3 as t from r3 join k1 using (g) join k2 using (g) join k3 using (g))
    select 'treat' as term, round(sum(t * y0) / sum(t * t), 2) as effect from alone""", ("programme",))
def adjusted_effect(t: Tables) -> DataFrame:
    found = causal.adjusted_effect(si.programme(t), "treat", "outcome", COVARIATES)
    return found.withColumn("effect", rounded(F.col("effect"), 2))


@query("stream_regression", """
    select round(regr_slope(y, x), 6) as beta, round(regr_intercept(y, x), 6) as alpha
    from (select (event_id % 100)::double as x, value as y from events)""")
def stream_regression(t: Tables) -> DataFrame:
    raw = read_stream(t.spark, "parquet", f"{t.folder}/events*.parquet", schema=t.events.schema)
    messages = raw.select(F.concat_ws(" ", F.col("event_id") % 100, "value").alias("value"))
    name = f"line_{uuid.uuid4().hex}"
    regression.start_stream(regression.regression_line(regression.parse_xy(messages)), "memory", name=name, once=True)
    return t.spark.table(name).select(rounded(F.col("beta")).alias("beta"), rounded(F.col("alpha")).alias("alpha"))
