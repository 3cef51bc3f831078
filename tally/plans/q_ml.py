"""Step 8 queries: scaling and encodings, splits, clustering, classifiers, metrics, text features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.functions import text as tx
from tally.operators import metrics as met, ml, segments as seg
from tally.plans.porter_sql import porter_sql
from tally.plans.registry import query
from tally.session import cut_lineage

RFM = ["recency", "frequency", "monetary"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def rfm(t):
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    return seg.rfm_table(o, "o_custkey", "o_orderdate", "o_totalprice")


_RFM_SQL = """
rfm as (
  select o_custkey,
         cast(floor((epoch_us((select max(o_orderdate) + interval 1 day from orders)) - epoch_us(max(o_orderdate))) / 86400e6) as bigint) as recency,
         cast(count(distinct o_orderdate) as bigint) as frequency,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) as monetary
  from orders group by o_custkey
)"""


#: the md5 split of ``ml.split_hash`` in SQL
_TRAIN_SQL = "substr(md5(cast({} as varchar)), 1, 4) < 'cccd'"


@query(
    "standard_scale",
    f"""with {_RFM_SQL}, parts as (select *, {_TRAIN_SQL.format("o_custkey")} as is_train from rfm),
f as (select """
    + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in RFM)
    + """ from parts where is_train)
select parts.*, """
    + ", ".join(f"round(case when s_{c} = 0 then 0 else ({c} - m_{c}) / s_{c} end, 9) as {c}_scaled" for c in RFM)
    + " from parts, f",
)
def standard_scale(t):
    """M1: population-std scaling of the RFM columns, fitted on the training customers, applied to all."""
    parts = cut_lineage(rfm(t).withColumn("is_train", ml.split_hash("o_custkey")))
    out = ml.apply_scaler(parts, ml.fit_scaler(parts.filter("is_train"), RFM))
    return out.withColumns({f"{c}_scaled": F.round(f"{c}_scaled", 9) for c in RFM})


@query(
    "ordinal_encode",
    f"""select o_orderkey, o_orderpriority,
       cast(list_position({PRIORITIES!r}, o_orderpriority) - 1 as integer) as priority_code from orders""",
)
def ordinal_encode(t):
    """M2: order priority as its position in the given order."""
    return t.orders.select("o_orderkey", "o_orderpriority", ml.ordinal_encode("o_orderpriority", PRIORITIES).alias("priority_code"))


@query(
    "one_hot",
    "select c_custkey, c_mktsegment, "
    + ", ".join(f"cast(c_mktsegment = '{v}' as integer) as c_mktsegment_{v}" for v in SEGMENTS[1:])
    + " from customer",
)
def one_hot(t):
    """M3: one-hot market segment, values learned from the training customers, first (sorted) one dropped."""
    c = t.customer.select("c_custkey", "c_mktsegment")
    return ml.one_hot(c, "c_mktsegment", ml.fit_one_hot(c.filter(ml.split_hash("c_custkey")), "c_mktsegment"))


@query("split_hash", "select o_orderkey, substr(md5(cast(o_orderkey as varchar)), 1, 4) < 'cccd' as is_train from orders")
def split_hash(t):
    """M4: reproducible 80/20 split from the md5 of the order key."""
    return t.orders.select("o_orderkey", ml.split_hash("o_orderkey", 0.8).alias("is_train"))


def _rfm_scaled(t):
    return ml.standard_scale(rfm(t), RFM)


_SCALED = [f"{c}_scaled" for c in RFM]


@query("kmeans_segments", None)
def kmeans_segments(t):
    """M5: k-means (k = 4) on scaled RFM."""
    return ml.kmeans_segments(_rfm_scaled(t), _SCALED, k=4).select("o_custkey", *RFM, "cluster")


@query("kmeans_elbow", None)
def kmeans_elbow(t):
    """M5: within-cluster sum of squares for k = 1..14."""
    return ml.kmeans_elbow(_rfm_scaled(t), _SCALED, ks=range(1, 15))


@query("bisecting_segments", None)
def bisecting_segments(t):
    """M6: bisecting k-means (k = 4) on scaled RFM (re-aimed hierarchical clustering)."""
    return ml.bisecting_segments(_rfm_scaled(t), _SCALED, k=4).select("o_custkey", *RFM, "cluster")


FEATURES = ["o_totalprice", "priority_code", "c_acctbal", "n_lines", "avg_discount"] + [f"c_mktsegment_{v}" for v in SEGMENTS[1:]]


def order_features(t):
    """orders + customer features; label = share of returned ('R') lines above 1/3."""
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.avg("l_discount").alias("avg_discount"),
        (F.count(F.when(F.col("l_returnflag") == "R", 1)) / F.count(F.lit(1)) > 1.0 / 3).cast("int").alias("label"),
    )
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", ml.ordinal_encode("o_orderpriority", PRIORITIES).alias("priority_code"))
    c = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    j = o.join(li, o.o_orderkey == li.l_orderkey).join(c, o.o_custkey == c.c_custkey)
    j = cut_lineage(j.withColumn("is_train", ml.split_hash("o_orderkey")))  # read by every fit and by the predictions
    return ml.one_hot(j, "c_mktsegment", ml.fit_one_hot(j.filter("is_train"), "c_mktsegment"))


def _split(t):
    f = order_features(t)
    return f.filter("is_train"), f.filter(~F.col("is_train"))


def _preds(df):
    return df.select("o_orderkey", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


@query("clf_tree", None)
def clf_tree(t):
    """M7: decision tree (depth 5, gini); test-split predictions."""
    tr, te = _split(t)
    return _preds(ml.clf_tree(tr, te, FEATURES, "label"))


@query("clf_forest", None)
def clf_forest(t):
    """M8: random forest (100 trees); test-split predictions."""
    tr, te = _split(t)
    return _preds(ml.clf_forest(tr, te, FEATURES, "label", num_trees=100))


@query("clf_logistic", None)
def clf_logistic(t):
    """M9: L2 logistic regression (C = 1) on scaled features; test-split predictions."""
    raw = order_features(t)
    return _preds(_logistic(raw))


def _logistic(raw):
    f = ml.apply_scaler(raw, ml.fit_scaler(raw.filter("is_train"), FEATURES))
    scaled = [f"{c}_scaled" for c in FEATURES]
    return ml.clf_logistic(f.filter("is_train"), f.filter(~F.col("is_train")), scaled, "label")


@query("clf_grid", None)
def clf_grid(t):
    """10-fold grid search over tree depth and leaf size; best model's test predictions."""
    tr, te = _split(t)
    return _preds(ml.clf_grid(tr, te, FEATURES, "label", "o_orderkey", depths=(3, 5), min_leaf=(1, 5), folds=10))


# ---- facts that hold for any right model -------------------------------------------------------

@query(
    "cluster_facts",
    """select method, (select count(distinct o_custkey) from orders) as n_rows, cast(4 as bigint) as n_clusters,
       cast(0 as bigint) as violations, true as cost_falls from (values ('kmeans'), ('bisecting')) v(method)""",
)
def cluster_facts(t):
    """M5 + M6: all customers, four clusters, nobody nearer to another k-means centre, less cost than one cluster."""
    data = cut_lineage(_rfm_scaled(t))
    km, centres = ml.kmeans_segments(data, _SCALED, k=4, with_centres=True)
    halves = ml.bisecting_segments(data, _SCALED, k=4)
    total = ml.total_ss(data, _SCALED).scalar()
    out = None
    for name, found, wrong in (("kmeans", km, ml.nearest_centre_violations(km, _SCALED, centres)), ("bisecting", halves, F.lit(0).cast("bigint").alias("violations"))):
        n = found.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cluster").alias("n_clusters"), wrong)
        per = found.groupBy("cluster").agg(ml.sum_of_squares(_SCALED).alias("ss")).agg(F.sum("ss")).scalar()
        row = n.select(F.lit(name).alias("method"), "n_rows", "n_clusters", "violations", (per < total).alias("cost_falls"))
        out = row if out is None else out.unionByName(row)
    return out


@query("elbow_facts", "select cast(k as integer) as k, true as at_most_total from range(1, 15) r(k)")
def elbow_facts(t):
    """M5: the cost for each k is at most that of one cluster."""
    e = cut_lineage(kmeans_elbow(t))
    total = e.filter("k = 1").agg(F.max("wcss")).scalar()
    return e.select("k", (F.col("wcss") <= total * (1 + 1e-9)).alias("at_most_total"))


_MODELS_SQL = """
label as (select l_orderkey as o_orderkey, cast(count(case when l_returnflag = 'R' then 1 end) / count(*) > 1.0 / 3 as integer) as label
          from lineitem group by 1),
held as (select label.* from orders join label using (o_orderkey) join customer on c_custkey = o_custkey
         where not (""" + _TRAIN_SQL.format("o_orderkey") + """))"""


@query(
    "classifier_facts",
    f"""with {_MODELS_SQL}
select model, count(*) as n, cast(sum(label) as bigint) as n_positive, true as near_majority
from held, (values ('tree'), ('forest'), ('logistic'), ('grid')) m(model) group by model""",
)
def classifier_facts(t):
    """Every held-out order is predicted once with its label, and accuracy is at least the majority share less
    3 points (labels of these tables are drawn at random, so no model can do better than the majority)."""
    raw = order_features(t)
    tr, te = raw.filter("is_train"), raw.filter(~F.col("is_train"))
    found = {
        "tree": ml.clf_tree(tr, te, FEATURES, "label"),
        "forest": ml.clf_forest(tr, te, FEATURES, "label", num_trees=100),
        "logistic": _logistic(raw),
        "grid": ml.clf_grid(tr, te, FEATURES, "label", "o_orderkey", depths=(3, 5), min_leaf=(1, 5), folds=10),
    }
    out = None
    for name, p in found.items():
        m = met.class_metrics(_preds(p), "label", "prediction")
        share = (F.col("tp") + F.col("fn")) / F.col("n")
        row = m.select(
            F.lit(name).alias("model"), "n", (F.col("tp") + F.col("fn")).alias("n_positive"),
            (F.col("accuracy") >= F.greatest(share, 1 - share) - 0.03).alias("near_majority"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def model_scores(t):
    """Held-out orders with the probability of the logistic model."""
    from pyspark.ml.functions import vector_to_array

    p = _logistic(order_features(t))
    return p.select("o_orderkey", F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("score"))


@query(
    "roc_facts",
    f"""with {_MODELS_SQL}
select cast(sum(label) as bigint) as positives, count(*) - cast(sum(label) as bigint) as negatives, true as rates_end_at_one,
       true as auc_is_rank_statistic from held""",
)
def roc_facts(t):
    """M15 on model output: the curve of the logistic probabilities ends at all positives and negatives, and its area
    equals the rank statistic (share of positive-negative pairs in right order, ties half) from average ranks."""
    s = cut_lineage(model_scores(t))
    pts = cut_lineage(met.roc_points(s, "label", "score"))
    area = met.auc(s, "label", "score").scalar()
    per = s.groupBy("score").agg(F.count(F.when(F.col("label") == 1, 1)).alias("p"), F.count(F.when(F.col("label") == 0, 1)).alias("q"))
    below = met.global_running_sum(cut_lineage(per), "score", ["q"])
    won = below.agg(F.sum(F.col("p") * (F.col("cum_q") - F.col("q") + F.col("q") / 2))).scalar()
    return pts.agg(F.max("tp").alias("positives"), F.max("fp").alias("negatives"), ((F.max("tpr") == 1) & (F.max("fpr") == 1)).alias("rates_end_at_one")).select(
        "*", (F.abs(area - won / (F.col("positives") * F.col("negatives"))) < 1e-9).alias("auc_is_rank_statistic")
    )


# ---- metrics on a SQL-exact score of many distinct values -------------------------------------

def scored(t):
    o = t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"), F.col("o_totalprice").alias("score"))
    return o.withColumn("pred", (F.col("score") >= 200000).cast("int"))


_SCORED_SQL = """
scored as (select o_orderkey, cast(o_orderstatus = 'F' as integer) as label, o_totalprice as score from orders),
sp as (select *, cast(score >= 200000 as integer) as pred from scored)"""


@query(
    "confusion_matrix",
    f"""with {_SCORED_SQL},
c as (select label, pred, count(*) as n from sp group by all),
g as (select a.label, b.pred from (select distinct label from sp) a, (select distinct pred from sp) b),
f as (select g.label, g.pred, coalesce(c.n, 0) as n from g left join c using (label, pred))
select label, pred, n, n / sum(n) over (partition by label) as share from f""",
)
def confusion_matrix(t):
    """Confusion matrix, raw and row-normalised."""
    return met.confusion_matrix(scored(t), "label", "pred")


@query(
    "class_metrics",
    f"""with {_SCORED_SQL},
a as (select count(*) as n, count(case when label = pred then 1 end) as correct,
             count(case when label = 1 and pred = 1 then 1 end) as tp, count(case when label <> 1 and pred = 1 then 1 end) as fp,
             count(case when label = 1 and pred <> 1 then 1 end) as fn from sp),
b as (select *, tp / nullif(tp + fp, 0) as precision, tp / nullif(tp + fn, 0) as recall from a)
select n, tp, fp, fn, correct / n as accuracy, precision, recall, 2 * precision * recall / nullif(precision + recall, 0) as f1 from b""",
)
def class_metrics(t):
    """M14 + M16: accuracy, precision, recall, F1."""
    return met.class_metrics(scored(t), "label", "pred")


_ROC_SQL = f"""{_SCORED_SQL},
per as (select score as threshold, count(case when label = 1 then 1 end) as pos, count(case when label <> 1 then 1 end) as neg
        from scored group by 1),
tot as (select sum(pos) as p, sum(neg) as n from per),
cum as (select threshold, pos, neg, cast(sum(pos) over w as bigint) as tp, cast(sum(neg) over w as bigint) as fp from per
        window w as (order by threshold desc rows between unbounded preceding and current row)),
pts as (select threshold, tp, fp, tp / nullif(p, 0) as tpr, fp / nullif(n, 0) as fpr,
               (tp - pos) / nullif(p, 0) as tpr_prev, (fp - neg) / nullif(n, 0) as fpr_prev from cum, tot)"""


@query("roc_points", f"with {_ROC_SQL} select threshold, tp, fp, tpr, fpr from pts")
def roc_points(t):
    """Exact ROC points, one per distinct score."""
    return met.roc_points(scored(t), "label", "score").select("threshold", "tp", "fp", "tpr", "fpr")


@query("auc", f"with {_ROC_SQL} select round(sum((fpr - fpr_prev) * (tpr + tpr_prev) / 2), 9) as auc from pts")
def auc(t):
    """Area under the ROC curve (trapezoids)."""
    return met.auc(scored(t), "label", "score").select(F.round("auc", 9).alias("auc"))


# ---- text ------------------------------------------------------------------------------------

def _stop_sql():
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in tx.stop_words()) + "]"


def texts(t):
    return t.documents.select("doc_id", "text")


@query(
    "text_clean",
    f"""with toks as (
  select doc_id, list_filter(string_split_regex(trim(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g'))), '\\s+'),
                             lambda w: length(w) >= 1 and not list_contains({_stop_sql()}, w)) as toks
  from documents)
select doc_id, array_to_string(toks, ' ') as clean_text, cast(len(toks) as integer) as n_tokens from toks""",
)
def text_clean(t):
    """X13 + X14: letters only, lower case, stop words removed, whole texts."""
    d = texts(t).withColumn("_t", tx.clean_tokens("text", tx.stop_words()))
    return d.select("doc_id", F.array_join("_t", " ").alias("clean_text"), F.size("_t").alias("n_tokens"))


def _doc_tokens(t):
    return tx.tokens_long(texts(t), "doc_id", "text", tx.stop_words())


def _tokens_sql():
    return f"""
toks as (
  select doc_id, token from (
    select doc_id, unnest(string_split_regex(trim(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g'))), '\\s+')) as token
    from documents)
  where length(token) >= 1 and token not in ({_stop_sql()[1:-1]})),
{porter_sql('toks').strip()},
per_doc as (
  select t.doc_id, s.stem as term, count(*) as tf from toks t join stems s using (token) group by all),
vocab as (
  select term, corpus_count, cast(row_number() over (order by term) - 1 as integer) as term_index from (
    select term, cast(sum(tf) as bigint) as corpus_count from per_doc where length(term) >= 2
    group by term order by corpus_count desc, term limit 1500))"""


@query("text_stem_vocab", f"with {_tokens_sql()} select token, stem from stems")
def text_stem_vocab(t):
    """Porter stem of every distinct token of the documents."""
    toks = _doc_tokens(t).groupBy("token").agg(F.count(F.lit(1)).alias("_c"))
    return tx.stem_vocabulary(toks)


@query("bow_vocab", f"with {_tokens_sql()} select term, corpus_count, term_index from vocab")
def bow_vocab(t):
    """1500 most frequent stems (ties alphabetical), alphabetical term index."""
    return tx.bow_vocabulary_from_counts(tx.stem_corpus_counts(_doc_tokens(t)), max_features=1500)


@query(
    "bow_vectors",
    f"with {_tokens_sql()} select p.doc_id, v.term_index, cast(p.tf as bigint) as tf from per_doc p join vocab v using (term)",
)
def bow_vectors(t):
    """Per document sparse stem counts over the 1500-term vocabulary."""
    tokens = _doc_tokens(t)
    _, numbers = tx.term_numbers(tokens, max_features=1500)
    return tx.bow_counts_by_token(tokens, cut_lineage(numbers), "doc_id").select("doc_id", "term_index", F.col("tf").cast("bigint").alias("tf"))


REVIEW_TERMS = 1500


def review_predictions(t, num_trees: int = 501):
    """M8 + M11 + M12: labelled documents as bags of stems, 75/25 split, entropy trees, predictions of the held-out ones."""
    rows = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", "quality"), "doc_id")
    tokens = tx.tokens_long(rows, "doc_id", "text", tx.stop_words())
    vocab, numbers = tx.term_numbers(tokens, max_features=REVIEW_TERMS)
    terms = [r["term"] for r in vocab.orderBy("term_index").collect()]  # at most REVIEW_TERMS
    counts = tx.bow_counts_by_token(tokens, cut_lineage(numbers), "doc_id")
    data = tx.bow_vectors(rows.select("doc_id", F.col("quality").cast("double").alias("label")), counts, terms, "doc_id")
    data = cut_lineage(data.withColumn("is_train", ml.split_hash("doc_id", 0.75)))
    return ml.forest_on_vectors(data.filter("is_train"), data.filter(~F.col("is_train")), num_trees=num_trees, impurity="entropy")


@query(
    "review_forest",
    """with held as (select doc_id, quality from labels join documents using (doc_id)
                where not (substr(md5(cast(doc_id as varchar)), 1, 4) < 'c000'))
select quality as label, count(*) as n, true as beats_majority from held group by quality""",
)
def review_forest(t):
    """M8 + M11 + M12 + M13: rows of the confusion matrix (held-out documents per label), and whether the forest is right
    at least as often as the larger label."""
    p = cut_lineage(review_predictions(t).select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")))
    cells = met.confusion_matrix(p, "label", "prediction")
    right = cells.agg(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")))).scalar()
    per = cells.groupBy("label").agg(F.sum("n").alias("n"))
    return per.withColumn("beats_majority", right >= per.agg(F.max("n")).scalar())
