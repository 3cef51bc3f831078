"""Step 7 queries: month spine, MA backtest and forecast, ensemble weights and blend, publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import ensemble as ens, forecast as fcst
from tally.plans.registry import query

CREATE = "2001-06-01"
RUN_A = "2001-06-01 06:30:00"
RUN_B = "2001-06-01 07:30:00"
APP = "demand_app"


def _create():
    return F.lit(CREATE).cast("date")


def brand_panel(t):
    """Dense brand x month panel, materialised once per query build (it feeds the backtest, the
    metrics and the forecast)."""
    from tally.session import cut_lineage

    return t.memo("brand_panel", lambda: cut_lineage(_brand_panel(t)))


def _brand_panel(t):
    li = t.lineitem.select("l_partkey", "l_shipdate", "l_quantity")
    p = t.part.select("p_partkey", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return fcst.panel_spine(j.select("p_brand", F.col("l_shipdate").alias("month"), F.col("l_quantity").alias("quantity")), "p_brand", "month", "quantity")


_PANEL_SQL = """
obs as (select p.p_brand, cast(date_trunc('month', l.l_shipdate) as date) as month, sum(l.l_quantity) as v
        from lineitem l join part p on l.l_partkey = p.p_partkey group by all),
b as (select p_brand, min(month) as f, max(month) as l from obs group by 1),
spine as (select p_brand, cast(unnest(generate_series(f, l, interval 1 month)) as date) as month from b),
panel as (select s.p_brand, s.month, coalesce(o.v, 0) as quantity from spine s left join obs o using (p_brand, month))"""


@query("panel_spine", f"with {_PANEL_SQL} select * from panel")
def panel_spine(t):
    """Dense month spine per brand, missing quantity = 0."""
    return brand_panel(t)


def _bt_sql():
    cols = ",\n  ".join(
        f"case when count(quantity) over (w rows between {k} preceding and 1 preceding) = {k} "
        f"then avg(quantity) over (w rows between {k} preceding and 1 preceding) end as f{k}"
        for k in fcst.MA_WINDOWS
    )
    unions = " union all ".join(
        f"select p_brand, month, quantity as actual, {k} as ma_window, f{k} as forecast from wide where f{k} is not null"
        for k in fcst.MA_WINDOWS
    )
    return f"""{_PANEL_SQL},
wide as (
  select p_brand, month, quantity,
  {cols}
  from panel window w as (partition by p_brand order by month)),
wide2 as (select * from wide where month between cast(date_trunc('month', date '{CREATE}' - interval 3 month) as date)
                                            and cast(date '{CREATE}' - interval 1 month as date)),
bt as ({unions.replace('from wide', 'from wide2')})"""


def _backtest(t):
    c = _create()
    from tally.functions.scalar import metrics_start

    return fcst.ma_backtest(brand_panel(t), "p_brand", "quantity", metrics_start(c), F.add_months(c, -1))


@query("ma_backtest", f"with {_bt_sql()} select * from bt")
def ma_backtest(t):
    """R2 + R4: MA(2..6) backtest over the three months before the create month."""
    return _backtest(t).withColumn("ma_window", F.col("ma_window").cast("int"))


@query(
    "ma_metrics",
    f"""with {_bt_sql()}
select ma_window, round(sum(abs(actual - forecast)) / nullif(sum(actual), 0) * 100, 6) as wmape,
       round(sum(forecast - actual) / nullif(sum(actual), 0) * 100, 6) as bias_pct
from bt group by ma_window""",
)
def ma_metrics(t):
    """Wmape and bias per MA window."""
    m = fcst.accuracy(_backtest(t), ["ma_window"])
    return m.select(F.col("ma_window").cast("int"), F.round("wmape", 6).alias("wmape"), F.round("bias_pct", 6).alias("bias_pct"))


_BEST_SQL = """
metrics as (select ma_window, sum(abs(actual - forecast)) / nullif(sum(actual), 0) * 100 as wmape,
                   sum(forecast - actual) / nullif(sum(actual), 0) * 100 as bias_pct from bt group by ma_window),
best as (select arg_min(ma_window, wmape + abs(bias_pct)) as ma_window from metrics)"""


def _best(t):
    return fcst.best_window(fcst.accuracy(_backtest(t), ["ma_window"]))


@query("best_window", f"with {_bt_sql()}, {_BEST_SQL} select cast(ma_window as integer) as ma_window from best")
def best_window(t):
    """B13 + F9: window with the least wmape + |bias|."""
    return _best(t).select(F.col("ma_window").cast("int"))


@query(
    "ma_forecast",
    f"""with {_bt_sql()}, {_BEST_SQL}
select p_brand, date '{CREATE}' as forecast_create_period, cast(tp as date) as forecast_target_period,
       sum(quantity) / (select ma_window from best) as forecast
from panel, (select unnest(generate_series(date '{CREATE}', date '{CREATE}' + interval 2 month, interval 1 month)) as tp)
where month < date '{CREATE}' and month >= date '{CREATE}' - to_months(cast((select ma_window from best) as integer))
group by p_brand, tp""",
)
def ma_forecast(t):
    """MA forecast with the best window for the three months from the create month."""
    w = _best(t).select(F.col("ma_window").cast("int")).scalar()
    return fcst.ma_forecast(brand_panel(t), "p_brand", "quantity", w, _create(), horizon=3)


# ---- ensemble ------------------------------------------------------------------------------

def region_brand_panel(t):
    """Dense (region|brand) x month panel, materialised once per query build."""
    from tally.session import cut_lineage

    return t.memo("region_brand_panel", lambda: cut_lineage(_region_brand_panel(t)))


def _region_brand_panel(t):
    li = t.lineitem.select("l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    p = t.part.select("p_partkey", "p_brand")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    j = (
        li.join(p, li.l_partkey == p.p_partkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    ids = j.select(F.concat_ws("|", "r_name", "p_brand").alias("id"), F.col("l_shipdate").alias("month"), F.col("l_quantity").alias("quantity"))
    return fcst.panel_spine(ids, "id", "month", "quantity")


def model_forecasts(t):
    sp = region_brand_panel(t)
    ma = fcst.ma_forecast(sp, "id", "quantity", F.lit(3), _create(), horizon=3)
    ml = fcst.seasonal_naive(sp, "id", "quantity", _create(), horizon=3, season=12)
    return sp, ma, ml


def weights(t):
    return t.memo("weights", lambda: _weights(t))


def _weights(t):
    sp, _, _ = model_forecasts(t)
    c = _create()
    bt = fcst.ma_backtest(sp, "id", "quantity", F.add_months(c, -3), F.add_months(c, -1), windows=(3,)).select(
        "id", "month", "actual", F.col("forecast").alias("ma_prediction")
    )
    past = sp.select("id", F.add_months("month", 12).alias("month"), F.col("quantity").cast("double").alias("ml_prediction"))
    bt = bt.join(past, ["id", "month"], "left").fillna(0.0, subset=["ml_prediction"])
    w = ens.ensemble_weights(bt, "id", ["ma", "ml"])
    brand_no = F.regexp_extract(F.col("id"), r"Brand#(\d+)", 1).cast("int")
    known = brand_no % 4 != 0
    return w.select("id", *[F.when(known, F.col(c)).alias(c) for c in w.columns if c != "id"])


_ENS_SQL = f"""
eobs as (select r.r_name || '|' || p.p_brand as id, cast(date_trunc('month', l.l_shipdate) as date) as month, sum(l.l_quantity) as v
         from lineitem l join part p on l.l_partkey = p.p_partkey join supplier s on l.l_suppkey = s.s_suppkey
         join nation n on s.s_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey group by all),
eb as (select id, min(month) as f, max(month) as l from eobs group by 1),
espine as (select id, cast(unnest(generate_series(f, l, interval 1 month)) as date) as month from eb),
ep as (select s.id, s.month, coalesce(o.v, 0) as quantity from espine s left join eobs o using (id, month)),
tgt as (select id, cast(tp as date) as forecast_target_period from (select distinct id from ep),
        (select unnest(generate_series(date '{CREATE}', date '{CREATE}' + interval 2 month, interval 1 month)) as tp)),
ma as (select t.id, date '{CREATE}' as forecast_create_period, t.forecast_target_period, m.forecast
       from tgt t join (select id, sum(quantity) / 3 as forecast from ep
                        where month < date '{CREATE}' and month >= date '{CREATE}' - interval 3 month group by id) m using (id)),
ml as (select t.id, date '{CREATE}' as forecast_create_period, t.forecast_target_period, coalesce(e.quantity, 0) as forecast
       from tgt t left join ep e on e.id = t.id and e.month = cast(t.forecast_target_period - interval 12 month as date)),
ebt0 as (select id, month, quantity as actual,
           case when count(quantity) over (partition by id order by month rows between 3 preceding and 1 preceding) = 3
                then avg(quantity) over (partition by id order by month rows between 3 preceding and 1 preceding) end as ma_prediction
         from ep),
ebt as (select b.id, b.month, b.actual, b.ma_prediction, coalesce(e.quantity, 0) as ml_prediction
        from ebt0 b left join ep e on e.id = b.id and e.month = cast(b.month - interval 12 month as date)
        where b.month between date '{CREATE}' - interval 3 month and date '{CREATE}' - interval 1 month and b.ma_prediction is not null),
winv as (select id, 1.0 / nullif(sum(abs(actual - ma_prediction)) / nullif(sum(actual), 0) + 1e-6, 0) as ima,
                    1.0 / nullif(sum(abs(actual - ml_prediction)) / nullif(sum(actual), 0) + 1e-6, 0) as iml from ebt group by id),
weights as (select id, case when known then ima / nullif(ima + iml, 0) end as weight_ma_prediction,
                   case when known then iml / nullif(ima + iml, 0) end as weight_ml_prediction
            from (select *, cast(regexp_extract(id, 'Brand#(\\d+)', 1) as integer) % 4 <> 0 as known from winv)),
j as (select split_part(a.id, '|', 1) as location, substr(a.id, strpos(a.id, '|') + 1) as product,
             a.forecast_create_period, a.forecast_target_period, a.forecast as ma_prediction, b.forecast as ml_prediction
      from ma a join ml b on a.id = b.id and a.forecast_target_period = b.forecast_target_period),
merged as (select j.*, j.location || '|' || j.product as id, w.weight_ma_prediction, w.weight_ml_prediction
           from j left join weights w on w.id = j.location || '|' || j.product),
blend as (
  select location, product, forecast_create_period, forecast_target_period, id,
         coalesce(ma_prediction, 0) as ma_prediction, coalesce(ml_prediction, 0) as ml_prediction,
         coalesce(weight_ma_prediction, (select avg(weight_ma_prediction) from merged), 1.0) as weight_ma_prediction,
         coalesce(weight_ml_prediction, (select avg(weight_ml_prediction) from merged), 0.0) as weight_ml_prediction
  from merged),
blended as (select *, ma_prediction * weight_ma_prediction + ml_prediction * weight_ml_prediction as forecast,
                   weight_ma_prediction + weight_ml_prediction as sum_weight from blend)"""


@query(
    "ensemble_weights",
    f"with {_ENS_SQL} select id, round(weight_ma_prediction, 9) as weight_ma_prediction, "
    "round(weight_ml_prediction, 9) as weight_ml_prediction from weights",
)
def ensemble_weights(t):
    """Inverse-wmape weights per id from a 3-month backtest (brands %4=0 have none)."""
    return weights(t).select("id", *[F.round(c, 9).alias(c) for c in ("weight_ma_prediction", "weight_ml_prediction")])


def blended(t):
    _, ma, ml = model_forecasts(t)
    return ens.ensemble_blend({"ma": ma, "ml": ml}, weights(t))


@query(
    "ensemble_blend",
    f"""with {_ENS_SQL}
select location, product, forecast_create_period, forecast_target_period, id, ma_prediction, ml_prediction,
       round(weight_ma_prediction, 9) as weight_ma_prediction, round(weight_ml_prediction, 9) as weight_ml_prediction,
       round(forecast, 6) as forecast, round(sum_weight, 9) as sum_weight
from blended""",
)
def ensemble_blend(t):
    """B14 + P10 + P17 + X8 + J5: MA x ML inner join, weights with mean fill, unnormalised blend."""
    b = blended(t)
    return b.select(
        "location", "product", "forecast_create_period", "forecast_target_period", "id", "ma_prediction", "ml_prediction",
        *[F.round(c, 9).alias(c) for c in ("weight_ma_prediction", "weight_ml_prediction")],
        F.round("forecast", 6).alias("forecast"),
        F.round("sum_weight", 9).alias("sum_weight"),
    )


def _frames(t):
    _, ma, ml = model_forecasts(t)
    return {"ma": ens.split_id(ma), "ml": ens.split_id(ml), "ensemble": blended(t)}



def published(t, run_utc: str, version: str, frames=None):
    frames = frames or _frames(t)
    return ens.publish_rows(frames, APP, {m: version for m in frames}, F.lit(run_utc).cast("timestamp"))


def _pub_sql(run_utc: str, version: str, name: str):
    stamp = f"(timestamp '{run_utc}' + interval 330 minute)"
    sel = (
        "'Monthly' as frequency, cast(cast(forecast as decimal(18,6)) as double) as forecast, "
        f"'{{m}}_{version}_' || strftime({stamp}, '%Y-%m-%d-%H_%M_%S') as model_version, product, '{APP}' as application, "
        "location, '{m}' as model_type, forecast_create_period, forecast_target_period, "
        f"{stamp} as create_timestamp, 'Warehouse Item Linkage' as level, {stamp} as modified, 1 as active"
    )
    split = "split_part(id, '|', 1) as location, substr(id, strpos(id, '|') + 1) as product, forecast_create_period, forecast_target_period, forecast"
    return f"""{name} as (
  select {sel.format(m='ma')} from (select {split} from ma)
  union all select {sel.format(m='ml')} from (select {split} from ml)
  union all select {sel.format(m='ensemble')} from blended)"""


@query("publish_rows", f"with {_ENS_SQL}, {_pub_sql(RUN_A, 'v1', 'pub')} select * from pub")
def publish_rows(t):
    """B15 + R7 + P7 + X31 + O6: the three models stamped into the 13-column layout."""
    return published(t, RUN_A, "v1").withColumn("forecast", F.col("forecast").cast("double"))


_ACTIVE_SQL = f"""{_pub_sql(RUN_A, 'v1', 'pub_a')}, {_pub_sql(RUN_B, 'v2', 'pub_b')},
pub_all as (select * from pub_a union all select * from pub_b),
newest as (select forecast_create_period, application, max(create_timestamp) as nt from pub_all group by all),
act as (select p.* exclude (active), cast(p.create_timestamp = n.nt as integer) as active
        from pub_all p join newest n using (forecast_create_period, application))"""


def _active(t):
    """Two runs appended to one published table (written once, as the publish step would), then
    the active flag is derived on read."""
    from tally.session import cut_lineage

    frames = _frames(t)
    both = published(t, RUN_A, "v1", frames).unionByName(published(t, RUN_B, "v2", frames))
    return ens.active_run(cut_lineage(both))


@query("active_run", f"with {_ENS_SQL}, {_ACTIVE_SQL} select * from act")
def active_run(t):
    """B16 + K5: two runs appended; the newer run of the create period is active."""
    return _active(t).withColumn("forecast", F.col("forecast").cast("double"))


@query(
    "forecast_totals",
    f"""with {_ENS_SQL}, {_ACTIVE_SQL}
select forecast_target_period, model_type, cast(sum(cast(forecast as decimal(18,6))) as double) as forecast_sum, count(*) as record_count
from act where active = 1 group by all""",
)
def forecast_totals(t):
    """Control totals of the active run per target period and model."""
    out = ens.forecast_totals(_active(t).filter(F.col("active") == 1))
    return out.withColumn("forecast_sum", F.col("forecast_sum").cast("double"))


def linkage(t):
    b = t.part.select(F.col("p_brand").alias("item_linkage")).distinct()
    num = F.regexp_extract("item_linkage", r"(\d+)", 1).cast("int")
    return b.select(
        "item_linkage",
        F.when(num % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("PL"), (num % 5).cast("string"))).alias("planning_linkage"),
        F.lit(1).alias("active"),
    )


def plan_targets(t):
    l = linkage(t)
    num = F.regexp_extract("item_linkage", r"(\d+)", 1).cast("int")
    return l.select(
        F.coalesce("planning_linkage", "item_linkage").alias("planning_linkage"),
        F.when(num % 7 == 0, F.lit("")).otherwise((num * 100).cast("string")).alias("final_target"),
    )


@query(
    "plan_vs_forecast",
    f"""with {_ENS_SQL}, {_ACTIVE_SQL},
lk as (select item_linkage,
              case when cast(regexp_extract(item_linkage, '(\\d+)', 1) as integer) % 3 = 0 then null
                   else 'PL' || cast(cast(regexp_extract(item_linkage, '(\\d+)', 1) as integer) % 5 as varchar) end as planning_linkage
       from (select distinct p_brand as item_linkage from part)),
tg as (select coalesce(planning_linkage, item_linkage) as planning_linkage,
              case when cast(regexp_extract(item_linkage, '(\\d+)', 1) as integer) % 7 = 0 then ''
                   else cast(cast(regexp_extract(item_linkage, '(\\d+)', 1) as integer) * 100 as varchar) end as final_target from lk),
fc as (select coalesce(n.planning_linkage, n.item_linkage) as planning_linkage, sum(a.forecast) as forecast_sum
       from act a join lk n on a.product = n.item_linkage
       where a.active = 1 and a.application = '{APP}' and a.model_type = 'ensemble'
         and a.forecast_create_period = date '{CREATE}' and a.forecast_target_period = date '{CREATE}'
       group by 1),
ts as (select planning_linkage, sum(case when final_target = '' then 0 else cast(final_target as double) end) as target_sum
       from tg group by 1),
c as (select ts.planning_linkage, round(target_sum, 6) as target_sum, round(forecast_sum, 6) as forecast_sum from ts join fc using (planning_linkage))
select * from c union all select null, round(sum(target_sum), 6), round(sum(forecast_sum), 6) from c
""",
)
def plan_vs_forecast(t):
    """B18 + J12 + J13 + A9: active ensemble forecast per planning link vs plan target, plus totals."""
    out = ens.plan_vs_forecast(_active(t), linkage(t), plan_targets(t), APP, _create())
    return out.select("planning_linkage", F.round("target_sum", 6).alias("target_sum"), F.round("forecast_sum", 6).alias("forecast_sum"))
