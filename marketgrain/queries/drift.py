"""Queries on drift between earlier and later sales."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.operators import daily as D, drift, modeling
from marketgrain.queries.base import ORACLES, Tables, query, r
from marketgrain.queries.reports import MARKET

NAMES = ["quantity", "unit_price", "amount", "item_code"]
CUT = "1998-06-01"


def _rows(t: Tables) -> DataFrame:
    return t.dirty_sales.select(
        S.DATE, F.abs(c(S.QUANTITY)).alias("quantity"), c(S.PRICE).alias("unit_price"),
        (c(S.QUANTITY) * c(S.PRICE)).alias("amount"), c(S.ITEM).alias("item_code"),
    )


def pair(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = _rows(t)
    return rows.where(c(S.DATE) < CUT), rows.where(c(S.DATE) >= CUT)


def longs(names=NAMES) -> str:
    """Long tables of both sides as expressions ``ref`` and ``cur``."""
    def side(test: str) -> str:
        return " union all ".join(
            f"select '{n}' as feature, cast({n} as double) as v from base where sale_date {test} date '{CUT}'" for n in names
        )

    return f"""base as (select sale_date, abs(quantity) as quantity, unit_price, quantity * unit_price as amount, item_code
               from dirty_sales), ref as ({side('<')}), cur as ({side('>=')})"""


_SKEW = """(avg(v * v * v) - 3 * avg(v) * avg(v * v) + 2 * avg(v) * avg(v) * avg(v)) / power(var_pop(v), 1.5)"""
STATS = f"""count(v) as n, avg(v) as mean, greatest(coalesce(stddev_samp(v), 0), 1e-8) as std, quantile_cont(v, 0.5) as median,
            quantile_cont(v, 0.25) as q25, quantile_cont(v, 0.75) as q75, min(v) as min, max(v) as max,
            case when count(v) > 3 and var_pop(v) > 1e-10 then {_SKEW} else 0 end as skewness,
            case when count(v) > 3 and var_pop(v) > 1e-10 then kurtosis_pop(v) else 0 end as kurtosis,
            (count(*) - count(v)) / cast(count(*) as double) as missing_rate"""


@query("d1_profile", f"""
    with {longs()}, s as (select feature, {STATS} from ref group by feature)
    select feature, n, {r('mean std median q25 q75 min max skewness kurtosis missing_rate')} from s""")
def profile(t):
    return drift.profile(pair(t)[0], NAMES)


def _statistical(names=NAMES) -> str:
    return f"""{longs(names)}, rs as (select feature, {STATS} from ref group by feature),
    cs as (select feature, {STATS} from cur group by feature),
    shifts as (select r.feature, abs(c.mean - r.mean) / r.std as mean_drift, abs(c.std - r.std) / r.std as std_drift,
                      abs(c.median - r.median) / r.std as median_drift from rs r join cs c on r.feature = c.feature),
    scored as (select *, (mean_drift + std_drift + median_drift) / 3 as drift_score,
                      (mean_drift + std_drift + median_drift) / 3 > 0.25 as drift_detected from shifts)"""


@query("d2_statistical_drift", f"""
    with {_statistical()} select feature, {r('mean_drift std_drift median_drift drift_score', 6)}, drift_detected from scored""",
       digits=6)
def statistical(t):
    return drift.detect(*pair(t), NAMES).select(
        "feature", "mean_drift", "std_drift", "median_drift", "drift_score", "drift_detected"
    )


@query("j12_profiles_joined", f"""
    with {_statistical()} select r.feature, r4(r.mean) as reference_mean, r4(c.mean) as current_mean
    from rs r join cs c on r.feature = c.feature""")
def profiles_joined(t):
    joined = drift.detect(*pair(t), NAMES)
    return joined.select(
        "feature", F.col("reference_stats.mean").alias("reference_mean"), F.col("current_stats.mean").alias("current_mean")
    )


_CDF = f"""{longs()}, counts as (select feature, v, sum(r) as r, sum(c) as c from (
        select feature, v, 1 as r, 0 as c from ref where v is not null
        union all select feature, v, 0, 1 from cur where v is not null) u group by feature, v),
    sizes as (select feature, cast(sum(r) as double) as nr, cast(sum(c) as double) as nc from counts group by feature),
    cdf as (select k.feature, v, nr, nc, sum(r) over w / nr as fr, sum(c) over w / nc as fc, lead(v) over w as nxt
            from counts k join sizes s on k.feature = s.feature window w as (partition by k.feature order by v))"""
_KS = f"""{_CDF}, ks as (select feature, max(abs(fr - fc)) as d, any_value(nr) as nr, any_value(nc) as nc from cdf group by feature),
    p as (select feature, any_value(d) as d, least(1.0, greatest(0.0, 2 * sum(power(-1, k - 1) * exp(-2.0 * k * k * d * d * nr * nc / (nr + nc)))))
          as p from ks, (select range as k from range(1, 101)) g group by feature)"""


@query("d3_ks", f"with {_KS} select feature, r6(d) as drift_score, r6(p) as p_value, p < 0.05 as drift_detected from p", digits=6)
def ks(t):
    """The asymptotic p-value, as its SQL has it; ``d3_ks_exact`` has the exact one of small samples."""
    return drift.ks_drift(*pair(t), NAMES, exact_rows=0).select("feature", "drift_score", "p_value", "drift_detected")


@query("d3_ks_exact", f"""
    with recursive days as ({MARKET}),
    sides as (select 'avg_price' as feature, sale_date < date '{CUT}' as early, avg_price as v from days
             union all select 'total_quantity', sale_date < date '{CUT}', total_quantity from days),
    counts as (select feature, v, count(*) filter (where early) as r, count(*) filter (where not early) as c from sides group by 1, 2),
    sizes as (select feature, sum(r) as nr, sum(c) as nc from counts group by 1),
    gaps as (select feature, max(abs(fr * nc - fc * nr)) as h, any_value(nr) as nr, any_value(nc) as nc from (
        select k.feature, nr, nc, sum(r) over w as fr, sum(c) over w as fc from counts k join sizes s on k.feature = s.feature
        window w as (partition by k.feature order by v)) x group by feature),
    sized as (select feature, cast(h as bigint) as h, cast(least(nr, nc) as bigint) as m, cast(greatest(nr, nc) as bigint) as n from gaps),
    rows(feature, i, j, paths, m, n, h) as (
        select feature, 0, j, case when j * m < h then 1.0::double else 0.0 end, m, n, h from (select *, unnest(range(0, n + 1)) as j from sized) x
        union all
        select feature, i + 1, j, case when abs((i + 1) * n - j * m) < h then sum(case when abs((i + 1) * n - j * m) < h then paths else 0 end)
            over (partition by feature order by j) * (i + 1) / (n + i + 1) else 0.0 end, m, n, h
        from rows where i < m)
    select feature, r6(h / (cast(m as double) * n)) as drift_score, r6(1 - paths) as p_value, 1 - paths < 0.05 as drift_detected
    from rows where i = m and j = n""", digits=6)
def ks_exact(t):
    """Daily prices and quantities of the whole market before and after, few enough for the exact p-value."""
    days = D.market_series(t.sales).select(S.DATE, F.col("Avg_Price").alias("avg_price"), F.col("Total_Quantity").alias("total_quantity"))
    parts = days.where(c(S.DATE) < CUT), days.where(c(S.DATE) >= CUT)
    return drift.detect(*parts, method="ks_test").select("feature", "drift_score", "p_value", "drift_detected")


@query("p29_texts", f"""
    with {_KS} select feature, case when p < 0.001 then printf('Highly significant drift (KS=%.3f, p<0.001)', d)
        when p < 0.01 then printf('Very significant drift (KS=%.3f, p<0.01)', d)
        when p < 0.05 then printf('Significant drift (KS=%.3f, p<0.05)', d)
        else printf('No significant drift (KS=%.3f, p=%.3f)', d, p) end as interpretation from p""")
def texts(t):
    return drift.detect(*pair(t), NAMES, "ks_test").select("feature", "interpretation")


_BINS = f"""{longs()},
    e as (select feature, list_sort(list_distinct(quantile_cont(v, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) as e from ref group by feature),
    spots as (select feature, unnest(range(1, len(e))) as bin from e where len(e) > 1),
    placed as (select u.feature, side, case when v < e[1] or v > e[len(e)] then 0
                      else least(len(list_filter(e, lambda x: x <= v)), len(e) - 1) end as bin
               from (select feature, v, 'r' as side from ref where v is not null
                     union all select feature, v, 'c' from cur where v is not null) u join e on u.feature = e.feature),
    sizes as (select feature, cast(count_if(side = 'r') as double) as nr, cast(count_if(side = 'c') as double) as nc
              from placed group by feature),
    shares as (select s.feature, s.bin, count_if(p.side = 'r') / any_value(nr) as r, count_if(p.side = 'c') / any_value(nc) as c
               from spots s left join placed p on s.feature = p.feature and s.bin = p.bin join sizes z on s.feature = z.feature
               group by s.feature, s.bin)"""


@query("d4_psi", f"""
    with {_BINS}, f as (select feature, case when r = 0 then 1e-4 else r end as r, case when c = 0 then 1e-4 else c end as c from shares),
    s as (select feature, sum((c - r) * ln(c / r)) as psi from f group by feature)
    select feature, r6(psi) as drift_score, psi > 0.25 as drift_detected,
           case when psi < 0.1 then printf('No significant change (PSI: %.3f)', psi) when psi < 0.25
                then printf('Some change detected (PSI: %.3f)', psi) else printf('Significant change detected (PSI: %.3f)', psi)
           end as interpretation from s""", digits=6)
def psi(t):
    return drift.detect(*pair(t), NAMES, "population_stability")


@query("d5_wasserstein", f"""
    with {_CDF}, w as (select feature, coalesce(sum(abs(fr - fc) * (nxt - v)), 0) as distance from cdf group by feature),
    s as (select feature, stddev_pop(v) as std from ref group by feature)
    select w.feature, r6(distance) as distance, r6(std) as std, r6(distance / greatest(std, 1e-3)) as drift_score,
           distance / greatest(std, 1e-3) >= 0.1 as drift_detected from w join s on w.feature = s.feature""", digits=6)
def wasserstein(t):
    return drift.detect(*pair(t), NAMES, "evidently")


_VERDICT = """v as (select count(*) as total_features, cast(count_if(drift_detected) as bigint) as drifted_features,
    avg(drift_score) as drift_score, max(drift_score) as max_drift_score, min(drift_score) as min_drift_score,
    count_if(drift_detected) / cast(count(*) as double) as drift_ratio from scored)"""


@query("d6_verdict", f"""
    with {_statistical()}, {_VERDICT}
    select total_features, drifted_features, {r('drift_score max_drift_score min_drift_score drift_ratio', 6)},
           drift_ratio > 0.3 or drift_score > 0.25 as overall_drift_detected from v""", digits=6)
def verdict(t):
    return drift.verdict(drift.detect(*pair(t), NAMES))


@query("d7_severity_counts", f"""
    with {_statistical()}
    select cast(count_if(drift_score > 0.5) as bigint) as high_drift,
           cast(count_if(drift_score > 0.2 and drift_score <= 0.5) as bigint) as medium_drift,
           cast(count_if(drift_score > 0.1 and drift_score <= 0.2) as bigint) as low_drift,
           cast(count_if(drift_score <= 0.1) as bigint) as none_drift from scored""")
def severity_counts(t):
    return drift.severity_counts(drift.detect(*pair(t), NAMES))


PREDICTIONS = """preds as (select 'lag_' || k as model, year(sale_date) as version, sale_date, item_code, avg_price as actual, predicted
    from (select 1 as k, sale_date, item_code, avg_price, lag(avg_price, 1) over (partition by item_code order by sale_date) as predicted from daily
          union all
          select 7, sale_date, item_code, avg_price, lag(avg_price, 7) over (partition by item_code order by sale_date) from daily) x)"""
_ERRORS = """avg(abs(actual - predicted)) as mae, avg(power(actual - predicted, 2)) as mse,
    avg(abs((actual - predicted) / nullif(actual, 0))) * 100 as mape, sqrt(avg(power(actual - predicted, 2))) as rmse,
    count(*) as sample_size"""


@query("d8_performance_drift", f"""
    with {PREDICTIONS}, now as (select model, {_ERRORS} from preds where predicted is not null and version >= 1998 group by model),
    base as (select model, avg(abs((actual - predicted) / nullif(actual, 0))) * 100 as base from preds
             where predicted is not null and version < 1998 and model = 'lag_1' group by model)
    select n.model, {r('mae mse mape rmse')}, sample_size, r4(coalesce(base, mape)) as baseline_mape,
           r4(case when coalesce(base, mape) > 0 then (mape - coalesce(base, mape)) / coalesce(base, mape) * 100 else 0 end) as degradation_pct,
           coalesce((mape - base) / base * 100 > 15, false) as performance_drift_detected
    from now n left join base b on n.model = b.model""")
def performance(t):
    rows = modeling.lag_predictions(t.daily)
    current = drift.prediction_errors(rows.where(F.col("version") >= 1998), ["model"])
    earlier = rows.where((F.col("version") < 1998) & (F.col("model") == "lag_1"))
    return drift.performance_drift(current, drift.prediction_errors(earlier, ["model"]), "model")


@query("d9_all_methods", digits=6)
def all_methods(t):
    """The four methods side by side."""
    reference, current = drift.stored_sides(*pair(t), NAMES)
    found = drift.distances(reference, current, NAMES)
    parts = [
        drift.detect(reference, current, NAMES, m, exact_rows=0, found=found).select(F.lit(m).alias("method"), "feature", "drift_score", "drift_detected")
        for m in drift.METHODS
    ]
    return reduce(DataFrame.unionByName, parts)


ORACLES["d9_all_methods"] = " union all ".join(
    f"select '{method}' as method, feature, drift_score, drift_detected from ({ORACLES[name]}) {name}"
    for method, name in zip(
        ("statistical", "evidently", "ks_test", "population_stability"),
        ("d2_statistical_drift", "d5_wasserstein", "d3_ks", "d4_psi"), strict=True)
)


def _strong(t):
    """Cheap against expensive sales: a pair that surely drifts."""
    rows = _rows(t).select("quantity", "unit_price")
    return rows.where(F.col("unit_price") < 20), rows.where(F.col("unit_price") >= 20)


@query("d10_alert", f"""
    with base as (select abs(quantity) as quantity, unit_price from dirty_sales),
    ref as (select 'quantity' as feature, quantity as v from base where unit_price < 20 union all select 'unit_price', unit_price from base where unit_price < 20),
    cur as (select 'quantity' as feature, quantity as v from base where unit_price >= 20 union all select 'unit_price', unit_price from base where unit_price >= 20),
    rs as (select feature, {STATS} from ref group by feature), cs as (select feature, {STATS} from cur group by feature),
    scored as (select r.feature, (abs(c.mean - r.mean) + abs(c.std - r.std) + abs(c.median - r.median)) / r.std / 3 as drift_score,
                      (abs(c.mean - r.mean) + abs(c.std - r.std) + abs(c.median - r.median)) / r.std / 3 > 0.25 as drift_detected
               from rs r join cs c on r.feature = c.feature), {_VERDICT}
    select 'data_drift' as alert_type, 'statistical' as method, r6(drift_score) as drift_score,
           printf('drift detected: score %.3f, %d of %d features drifted (%.2f%%), method statistical', drift_score,
                  drifted_features, total_features, drift_ratio * 100) as message
    from v where drift_ratio > 0.3 or drift_score > 0.25""", digits=6)
def alert(t):
    return drift.alert(drift.verdict(drift.detect(*_strong(t), ["quantity", "unit_price"])), "statistical")


@query("d11_chi_square", """
    with x as (select 'lang' as feature, lang as v, doc_id % 2 as side from documents
               union all select 'source', source, doc_id % 2 from documents),
    n as (select feature, v, cast(count_if(side = 0) as double) as r, cast(count_if(side = 1) as double) as c from x group by 1, 2),
    s as (select feature, sum(r) as nr, sum(c) as nc from n group by 1)
    select n.feature, r4(sum(power(c - r * nc / nr, 2) / (r * nc / nr))) as drift_score, count(*) - 1 as degrees_of_freedom
    from n join s on n.feature = s.feature where r > 0 group by n.feature""")
def chi_square(t):
    docs = t.raw("documents").select("lang", "source", (F.col("doc_id") % 2).alias("side"))
    return drift.chi_square(docs.where("side = 0"), docs.where("side = 1"), ["lang", "source"])


@query("d11_jensen_shannon", f"""
    with {_BINS} select feature, r6(sqrt(greatest(sum((case when r > 0 then r * ln(r / ((r + c) / 2)) else 0 end
        + case when c > 0 then c * ln(c / ((r + c) / 2)) else 0 end) / 2), 0))) as drift_score from shares group by feature""", digits=6)
def jensen_shannon(t):
    return drift.jensen_shannon(*pair(t), NAMES)


@query("d12_ranked", f"""
    with {_statistical()} select feature, r6(drift_score) as drift_score, drift_detected,
        case when drift_score > 0.5 then 'high' when drift_score > 0.2 then 'medium' when drift_score > 0.1 then 'low' else 'none' end
        as severity from scored order by drift_score desc, feature limit 5""", digits=6)
def ranked(t):
    return drift.ranked(drift.detect(*pair(t), NAMES), 5)
