"""Queries over training-data preparation, the classifiers and their explanations.

Models are fitted once per session and stored feature layer and shared by the queries that look at them: on all rows, by the ``fast``
searches of ``models.GRIDS``, with folds by key.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlake.operators import evaluate as V
from flowlake.operators import explain as X
from flowlake.operators import mlprep as M
from flowlake.operators import models
from flowlake.operators import registry as R
from flowlake.plans.catalog import query
from flowlake.plans.cleaning import stored_gold
from flowlake.plans.sql import NUMERIC, draw, union, with_clean, with_gold
from flowlake.plans.training import train_and_log
from flowlake.session import scratch_path
from flowlake.sources.messages import table_stream
from flowlake.sources.tables import read_csv
from flowlake.streaming import scoring
from flowlake.streaming.commits import make_folder

SEED = 42
TRAIN = f"{draw('flow_key', SEED)} < {int(0.8 * M.RESOLUTION)}"

# --- preparation

_CLASS_TABLE = """
classes as (
  select (row_number() over (order by n desc, name) - 1)::double as label, name, n,
    sum(n) over () / (count(*) over () * n)::double as weight
  from (select Attack_type as name, count(*) as n from gold group by 1))"""


@query("ml_features_binary", with_gold(
    "select Attack_label::double as label, count(*) as n, " + str(len(NUMERIC)) + " as width, "
    + ", ".join(f"round(sum({c}::double), 2) as {c}" for c in NUMERIC) + " from gold group by 1"))
def ml_features_binary(spark, sf):
    data = M.prepare_binary(stored_gold(spark, sf), features=NUMERIC)
    cells = data.select("label", vector_to_array("features").alias("x"))
    return cells.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"),
        *[F.round(F.sum(F.col("x")[i]), 2).alias(c) for i, c in enumerate(NUMERIC)],
    )


@query("label_index", with_gold(f", {_CLASS_TABLE} select label, name, n, round(weight, 6) as weight from classes"))
def label_index(spark, sf):
    return M.class_table(stored_gold(spark, sf), "Attack_type").withColumn("weight", F.round("weight", 6))


@query("class_weights", with_gold("""
select Attack_label, count(*) as n, round((select count(*) from gold)
  / ((select count(distinct Attack_label) from gold) * count(*))::double, 6) as weight from gold group by 1"""))
def class_weights(spark, sf):
    return M.class_weights(stored_gold(spark, sf), "Attack_label").withColumn("weight", F.round("weight", 6))


@query("weight_column", with_gold(f""", {_CLASS_TABLE}
select flow_key, Attack_type, round(case when Attack_type = 'MITM' then 1.0::double else weight end, 6) as "classWeight"
from gold join classes on name = Attack_type"""))
def weight_column(spark, sf):
    df = stored_gold(spark, sf).select("flow_key", "Attack_type")
    weights = M.class_weights(df, "Attack_type").filter("Attack_type <> 'MITM'")  # absent: falls back to 1
    return M.add_weights(df, weights, "Attack_type").withColumn("classWeight", F.round("classWeight", 6))


@query("split_sizes", with_gold(f"""
select Attack_type, count(case when {TRAIN} then 1 end) as n_train, count(case when not ({TRAIN}) then 1 end) as n_test
from gold group by 1"""))
def split_sizes(spark, sf):
    train, test = M.split(stored_gold(spark, sf).select("flow_key", "Attack_type"), ["flow_key"], seed=SEED)
    sides = train.withColumn("_t", F.lit(1)).unionByName(test.withColumn("_t", F.lit(0)))
    return sides.groupBy("Attack_type").agg(
        F.sum("_t").alias("n_train"), F.sum(1 - F.col("_t")).alias("n_test")
    )


@query("split_exact", with_clean("""
""" + f"""
, k as (select Attack_type, {draw('flow_key', SEED)} as d, count(*) as n from clean group by 1, 2),
w as (select *, sum(n) over (partition by Attack_type order by d) as upto, sum(n) over (partition by Attack_type) as whole from k)
select Attack_type, coalesce(sum(case when upto <= floor(whole * 0.8::double) then n end), 0)::bigint as n_train,
  coalesce(sum(case when upto > floor(whole * 0.8::double) then n end), 0)::bigint as n_test from w group by 1"""))
def split_exact(spark, sf):
    df = stored_gold(spark, sf).select("flow_key", "Attack_type")
    train, test = M.split_exact(df, ["flow_key"], "Attack_type", seed=SEED)
    sides = train.withColumn("_t", F.lit(1)).unionByName(test.withColumn("_t", F.lit(0)))
    return sides.groupBy("Attack_type").agg(
        F.sum("_t").alias("n_train"), F.sum(1 - F.col("_t")).alias("n_test")
    )


@query("split_disjoint", with_gold(f"""
select 0::bigint as shared_keys, count(case when not ({TRAIN}) then 1 end) as complement_rows from gold"""))
def split_disjoint(spark, sf):
    df = stored_gold(spark, sf).select("flow_key")
    train, test = M.split(df, ["flow_key"], seed=SEED)
    shared = M.overlap(train, test, ["flow_key"]).agg(F.count(F.lit(1)).alias("shared_keys"))
    rest = M.complement(df, train, ["flow_key"]).agg(F.count(F.lit(1))).scalar()
    return shared.withColumn("complement_rows", rest)


@query("split_random", with_gold("select count(*) as total, true as near_ratio from gold"))
def split_random(spark, sf):
    train, test = M.split_random(stored_gold(spark, sf).select("flow_key"), seed=SEED)
    sides = train.withColumn("_t", F.lit(1)).unionByName(test.withColumn("_t", F.lit(0)))
    return sides.agg(
        F.count(F.lit(1)).alias("total"), (F.abs(F.avg("_t") - 0.8) < 0.05).alias("near_ratio")
    )


@query("class_counts", with_gold(f", {_CLASS_TABLE} select label, n from classes"))
def class_counts(spark, sf):
    return M.class_counts(M.prepare_multiclass(stored_gold(spark, sf), features=["tcp_len"]).data)


@query("ml_prep", with_gold(f""", {_CLASS_TABLE}
select label, name, count(case when {TRAIN} then 1 end) as n_train, count(case when not ({TRAIN}) then 1 end) as n_test,
  round(sum(weight), 4) as weight_sum, {len(NUMERIC)} as width
from gold join classes on name = Attack_type group by 1, 2"""))
def ml_prep(spark, sf):
    sets = M.training_set(stored_gold(spark, sf), ["flow_key"], features=NUMERIC, seed=SEED, persist=False)
    sides = sets.train.withColumn("_t", F.lit(1)).unionByName(sets.test.withColumn("_t", F.lit(0)))
    counts = sides.groupBy("label").agg(
        F.sum("_t").alias("n_train"), F.sum(1 - F.col("_t")).alias("n_test"),
        F.round(F.sum("classWeight"), 4).alias("weight_sum"),
        F.max(F.size(vector_to_array("features"))).alias("width"),
    )
    return counts.join(F.broadcast(sets.classes.select("label", "name")), "label")  # one row per class


@query("ml_prep_binary", with_gold(f"""
select Attack_label::double as label, count(case when {TRAIN} then 1 end) as n_train,
  count(case when not ({TRAIN}) then 1 end) as n_test, round((select count(*) from gold) / 2.0::double, 3) as weight_sum
from gold group by Attack_label"""))
def ml_prep_binary(spark, sf):
    sets = M.training_set(stored_gold(spark, sf), ["flow_key"], multiclass=False, features=NUMERIC, seed=SEED, persist=False)
    sides = sets.train.withColumn("_t", F.lit(1)).unionByName(sets.test.withColumn("_t", F.lit(0)))
    return sides.groupBy("label").agg(
        F.sum("_t").alias("n_train"), F.sum(1 - F.col("_t")).alias("n_test"),
        F.round(F.sum("classWeight"), 3).alias("weight_sum"),
    )


def _scaled(spark, sf, scaler):
    data = M.assemble(stored_gold(spark, sf), NUMERIC, [F.col("Attack_label").cast("double").alias("label")])
    fitted = scaler.fit(data)
    cells = fitted.transform(data).select("label", vector_to_array("scaled_features").alias("x"))
    wide = cells.agg(*[
        f(F.col("x")[i]).alias(f"{m}{i}") for i in range(len(NUMERIC)) for m, f in [("lo", F.min), ("hi", F.max), ("av", F.avg)]
    ])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(f"lo{i}"), 6).alias("min_scaled"),
                 F.round(F.col(f"hi{i}"), 6).alias("max_scaled"), F.round(F.col(f"av{i}"), 6).alias("mean_scaled"))
        for i, c in enumerate(NUMERIC)
    ])))


@query("standard_scale", with_gold(union(
    f"select '{c}' as feature, round(min({c}) / stddev_samp({c}), 6) as min_scaled, "
    f"round(max({c}) / stddev_samp({c}), 6) as max_scaled, round(avg({c} / s), 6) as mean_scaled "
    f"from gold, (select stddev_samp({c}) as s from gold)" for c in NUMERIC)))
def standard_scale(spark, sf):
    return _scaled(spark, sf, M.standard_scaler())


@query("minmax_scale", with_gold(union(
    f"select '{c}' as feature, 0.0::double as min_scaled, 1.0::double as max_scaled, "
    f"round(avg(({c} - lo) / (hi - lo)), 6) as mean_scaled "
    f"from gold, (select min({c}) as lo, max({c}) as hi from gold)" for c in NUMERIC)))
def minmax_scale(spark, sf):
    return _scaled(spark, sf, M.minmax_scaler())


# --- fitting

MODE = "fast"
_FITTED: dict[tuple, tuple] = {}


def fitted(spark, sf, kind):
    """``(cross-validated model, training set)``, fitted on the whole feature layer."""
    gold = stored_gold(spark, sf)
    key = (tuple(sorted(gold.inputFiles())), kind)  # a layer that is written anew has other files
    if key not in _FITTED:
        sets = M.training_set(gold, ["flow_key"], features=NUMERIC, seed=SEED)
        model = models.tune(sets.train, kind, mode=MODE, parallelism=4)
        sets.release()
        _FITTED[key] = (model, sets)
    return _FITTED[key]


def _test_metrics(spark, sf, kind):
    model, sets = fitted(spark, sf, kind)
    result = V.multiclass_metrics(models.score(sets.test, model))
    return result.select("n", *[F.round(c, 6).alias(c) for c in result.columns[1:]])


# The multinomial Bayes model in SQL: scaled training sums, the smoothing that two folds by key prefer, log likelihoods, scores of the test side.
_BAYES = f""", {_CLASS_TABLE},
side as (select gold.*, label, name, {TRAIN} as in_train from gold join classes on name = Attack_type),
""" + ",\n".join(
    f"r_{c} as (select min({c}) as lo, max({c}) as hi from side where in_train)" for c in NUMERIC
) + """,
cells as (
""" + union(
    f"select flow_key, label, name, in_train, {j} as j, '{c}' as feature, "
    f"case when hi > lo then ({c} - lo) / (hi - lo) else 0.5 end as x from side, r_{c}"
    for j, c in enumerate(NUMERIC)
) + f"""),
sums as (select label, name, j, feature, sum(x) as s from cells where in_train group by all),
folded as (select *, row_number() over () as rid, cast(floor({draw('flow_key', SEED + 2)} * 2 / 4294967296) as integer) as fold
  from side where in_train),
parted as (
""" + union(f"select rid, label, fold, {j} as j, {c}::double as x from folded" for j, c in enumerate(NUMERIC)) + f"""),
two as (select * from (values (0), (1)) as t(held)), ways as (select * from (values (0.5::double), (1.0::double)) as t(a)),
bounds as (select held, j, min(x) as lo, max(x) as hi from parted, two where fold <> held group by all),
scaled as (select held, rid, label, fold, j, case when hi > lo then (x - lo) / (hi - lo) else 0.5 end as x from parted join bounds using (j)),
cv_sums as (select held, label, j, sum(x) as s from scaled where fold <> held group by all),
cv_theta as (select held, a, label, j, ln(s + a) - ln(sum(s) over (partition by held, a, label) + {len(NUMERIC)} * a) as v from cv_sums, ways),
cv_pi as (select held, a, label, ln(n + a) - ln(sum(n) over (partition by held, a) + count(*) over (partition by held, a) * a) as v
  from (select held, label, count(*)::double as n from folded, two where fold <> held group by all), ways),
cv_best as (select held, a, rid, label, arg_max(cls, score) as guess from (
  select c.held, t.a, c.rid, c.label, t.label as cls, any_value(p.v) + sum(c.x * t.v) as score
  from scaled c join cv_theta t on t.held = c.held and t.j = c.j join cv_pi p on p.held = c.held and p.a = t.a and p.label = t.label
  where c.fold = c.held group by all) group by all),
cv_pairs as (select held, a, label, guess, count(*)::double as n from cv_best group by all),
cv_f1 as (select held, a, sum(t * 2 * h / (t + coalesce(p, 0))) / sum(t) as f1 from (
  select held, a, label as c, sum(n) as t, sum(case when label = guess then n else 0 end) as h from cv_pairs group by all)
  left join (select held, a, guess as c, sum(n) as p from cv_pairs group by all) using (held, a, c) group by all),
pick as (select a from (select a, round(avg(f1), 12) as f1 from cv_f1 group by a) order by f1 desc, a limit 1),
theta as (select label, name, j, feature, ln(s + (select a from pick)) - ln(sum(s) over (partition by label) + {len(NUMERIC)} * (select a from pick)) as v
  from sums),
pi as (select label, name, ln(n + (select a from pick)) - ln(sum(n) over () + count(*) over () * (select a from pick)) as v
  from (select label, name, count(*)::double as n from side where in_train group by all)),
"""


def _bayes(body: str) -> str:
    return with_gold(_BAYES.rstrip().rstrip(",") + "\n" + body)


# Test rows may share a flow_key, so rows are numbered before they are unpivoted.
_BAYES_SCORED = with_gold(
    _BAYES.replace("in_train from gold join", "in_train, row_number() over () as rowno from gold join")
    .replace("select flow_key, label, name, in_train,", "select flow_key, rowno, label, name, in_train,")
    + """best as (select rowno, label, arg_max(cls, score) as prediction from (
  select c.rowno, c.label, t.label as cls, any_value(p.v) + sum(c.x * t.v) as score
  from cells c join theta t using (j) join pi p on p.label = t.label where not c.in_train
  group by all) group by rowno, label)
""")


@query("train_lr")
def train_lr(spark, sf):
    return _test_metrics(spark, sf, "logistic_regression")


@query("train_dt")
def train_dt(spark, sf):
    return _test_metrics(spark, sf, "decision_tree")


@query("train_rf")
def train_rf(spark, sf):
    return _test_metrics(spark, sf, "random_forest")


@query("train_gbt")
def train_gbt(spark, sf):
    return _test_metrics(spark, sf, "gbt")


@query("cv_results")
def cv_results(spark, sf):
    model, sets = fitted(spark, sf, "decision_tree")
    return models.cv_results(sets.train, model)


_KINDS = ["logistic_regression", "decision_tree", "random_forest", "gbt"]


@query("train_checks", with_gold(union(
    f"select '{kind}' as model, count(*) as n, true as in_range, true as noisy, {str(kind != 'logistic_regression').lower()} as beats_majority, "
    f"true as recomputed from gold where not ({TRAIN})" for kind in _KINDS)))
def train_checks(spark, sf):
    """What SQL can say of fitted models: test rows by the hash split, metrics in range and equal to those recomputed
    from the confusion table, below 1 because the label is noisy, and above always naming the majority (the linear
    model, whose weighted classes trade that away, is exempt)."""
    rows = []
    for kind in _KINDS:
        model, sets = fitted(spark, sf, kind)
        scored = models.score(sets.test, model)
        m = V.multiclass_metrics(scored).first()
        table = V.confusion_matrix(scored, sets.labels).collect()  # one row per class
        hits = sum(r[f"p{int(r['label'])}"] for r in table)
        share = max(r["row_total"] for r in table) / sum(r["row_total"] for r in table)
        values = [m[c] for c in ("accuracy", "f1_score", "precision", "recall")]
        beats = m["accuracy"] > share if kind != "logistic_regression" else False
        rows.append((kind, m["n"], all(0 <= v <= 1 for v in values), m["accuracy"] < 1.0, beats, abs(m["accuracy"] - hits / m["n"]) < 1e-9))
    return spark.createDataFrame(rows, "model string, n long, in_range boolean, noisy boolean, beats_majority boolean, recomputed boolean")


@query("train_and_log", with_gold(f""", t as (select count(*) as n from gold where not ({TRAIN}))
select 'search' as report, 4::bigint as rows_written, 0::bigint as total from t
union all select 'importance', {len(NUMERIC)}, 0 from t union all select 'confusion', 5, n from t
union all select 'metrics', 5, 0 from t union all select 'best run', 1, 0 from t"""))
def train_log(spark, sf):
    """A decision tree from the feature layer to the run log and the CSV reports, read back."""
    root, reports = scratch_path(spark, "runs"), scratch_path(spark, "reports")
    run = train_and_log(spark, stored_gold(spark, sf), ["flow_key"], "decision_tree", root, "dt_v1", NUMERIC, MODE, reports, SEED)
    csv = {name: read_csv(spark, f"{reports}/{name}") for name in ("search", "importance", "confusion")}
    log = R.read_registry(spark, root)
    best = R.best_runs(R.runs_wide(log["runs"], log["tags"], log["metrics"])).filter(F.col("run_id") == run.run_id)
    count = lambda df: df.count()  # noqa: E731  a few rows each
    total = csv["confusion"].agg(F.sum("row_total")).first()[0]
    rows = [("search", count(csv["search"]), 0), ("importance", count(csv["importance"]), 0), ("confusion", count(csv["confusion"]), int(total)),
            ("metrics", count(R.run_metrics(log["metrics"], run.run_id)), 0), ("best run", count(best), 0)]
    return spark.createDataFrame(rows, "report string, rows_written long, total long")


@query("binary_metrics", with_gold(f"""
select count(*) as n, true as auc_in_range, true as above_chance from gold where not ({TRAIN})"""))
def binary_metrics(spark, sf):
    """A binary model's probability vectors evaluated in one row."""
    sets = M.training_set(stored_gold(spark, sf), ["flow_key"], multiclass=False, features=NUMERIC, seed=SEED)
    model = models.tune(sets.train, "decision_tree", mode=MODE, parallelism=4)
    sets.train.unpersist()
    row = V.binary_metrics(models.score(sets.test, model))
    return row.select("n", F.col("auc_roc").between(0, 1).alias("auc_in_range"), (F.col("auc_roc") > 0.5).alias("above_chance"))


# --- what SQL can repeat of trees

_FEW = ["tcp_flags", "tcp_connection_syn", "tcp_connection_fin", "tcp_connection_rst"]


@query("stump", with_gold(", h as (" + union(
    f"select '{c}' as feature, {c}::double as v, Attack_type as cls, count(*)::double as n from gold where {TRAIN} group by all" for c in _FEW) + """),
cuts as (select feature, (v + lead(v) over (partition by feature order by v)) / 2 as t from (select distinct feature, v from h)),
sides as (select feature, t, v <= t as is_left, cls, sum(n) as n from cuts join h using (feature) where t is not null group by all),
g as (select feature, t, is_left, sum(n) as n, 1 - sum(n * n) / (sum(n) * sum(n)) as gini from sides group by all),
root as (select sum(n) as n, 1 - sum(n * n) / (sum(n) * sum(n)) as gini from (
  select cls, sum(n) as n from h where feature = 'tcp_flags' group by cls)),
gains as (select feature, t, any_value(root.gini) - sum(g.n * g.gini) / any_value(root.n) as gain from g, root group by feature, t),
best as (select feature as f, t, gain from gains order by round(gain, 9) desc, feature limit 1)
select h.feature, case when h.feature = f then 1.0 else 0.0 end::double as importance, case when h.feature = f then round(t, 6) end as threshold,
  case when h.feature = f then round(gain, 6) end as gain from (select distinct feature from h) h, best"""))
def stump(spark, sf):
    """A tree of depth 1 over features of few values, where its candidate cuts are all cuts there are."""
    sets = M.training_set(stored_gold(spark, sf), ["flow_key"], features=_FEW, seed=SEED)
    pipeline, stage = models.estimator("decision_tree", weighted=False)
    model = pipeline.copy({stage.maxDepth: 1}).fit(sets.train)
    root = X.root_split(spark, model, _FEW)
    sets.release()
    return X.tree_importance(spark, model, _FEW).join(root, "feature", "left").select(
        "feature", "importance", F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"))


_CHECKS = ["every tree of a forest is counted", "importances of a forest add up to 1", "importances of one-vs-rest add up to 1", "leaves are nodes + 1 halved",
           "linear importance is the mean absolute weight", "objective deltas add up", "objective falls", "one boosted model per class"]


@query("explain_checks", union(f"select '{c}' as what, true as holds" for c in _CHECKS))
def explain_checks(spark, sf):
    """The explanations of fitted models against each other and against the models' own series."""
    forest, sets = fitted(spark, sf, "random_forest")
    gbt, _ = fitted(spark, sf, "gbt")
    tree, _ = fitted(spark, sf, "decision_tree")
    linear, _ = fitted(spark, sf, "logistic_regression")
    total = lambda df, c: df.agg(F.sum(c)).first()[0]  # noqa: E731  a row per feature, tree or iteration
    whole, trees = X.forest_structure(spark, forest).first(), X.forest_trees(spark, forest)
    boosted = X.forest_structure(spark, gbt, sets.labels)
    text = X.tree_structure(spark, tree, None).first()
    steps = X.objective_history(spark, linear).orderBy("iteration").collect()
    weights = abs(X.last_stage(linear).coefficientMatrix.toArray()).mean(axis=0)
    ranked = {r["feature"]: r["importance"] for r in X.linear_importance(spark, linear, sets.features, sets.labels).collect()}
    holds = [
        whole["num_trees"] == trees.count() == len(X.last_stage(forest).trees) and whole["total_nodes"] == total(trees, "num_nodes"),
        abs(total(X.tree_importance(spark, forest, sets.features), "importance") - 1) < 1e-9,
        abs(total(X.ovr_importance(spark, gbt, sets.features), "importance") - 1) < 1e-9,
        text["num_leaves"] == text["preview"].count("Predict:") and 2 * text["num_leaves"] - 1 == text["num_nodes"],
        all(abs(ranked[f] - w) < 1e-12 for f, w in zip(sets.features, weights)),
        abs(sum(r["objective_delta"] for r in steps) - (steps[-1]["objective"] - steps[0]["objective"])) < 1e-9,
        all(r["objective_delta"] <= 0 for r in steps),
        boosted.count() == len(sets.labels) and boosted.filter(F.col("num_trees") == X.last_stage(gbt).models[0].getNumTrees).count() == len(sets.labels),
    ]
    return spark.createDataFrame(list(zip(_CHECKS, map(bool, holds))), "what string, holds boolean")


# --- explanations

@query("lr_importance")
def lr_importance(spark, sf):
    model, sets = fitted(spark, sf, "logistic_regression")
    return X.linear_importance(spark, model, sets.features, sets.labels)


@query("lr_top_per_class")
def lr_top_per_class(spark, sf):
    model, sets = fitted(spark, sf, "logistic_regression")
    return X.linear_top_per_class(spark, model, sets.features, sets.labels)


@query("objective_history")
def objective_history(spark, sf):
    model, _ = fitted(spark, sf, "logistic_regression")
    return X.objective_history(spark, model)


@query("tree_importance")
def tree_importance(spark, sf):
    model, sets = fitted(spark, sf, "random_forest")
    return X.tree_importance(spark, model, sets.features)


@query("tree_structure")
def tree_structure(spark, sf):
    model, _ = fitted(spark, sf, "decision_tree")
    return X.tree_structure(spark, model)


@query("forest_structure")
def forest_structure(spark, sf):
    model, _ = fitted(spark, sf, "random_forest")
    return X.forest_structure(spark, model)


@query("ovr_importance")
def ovr_importance(spark, sf):
    model, sets = fitted(spark, sf, "gbt")
    return X.ovr_importance(spark, model, sets.features)


@query("ovr_structure")
def ovr_structure(spark, sf):
    model, sets = fitted(spark, sf, "gbt")
    return X.forest_structure(spark, model, sets.labels)


@query("nb_importance", _bayes("""
select feature, round(var_pop(v), 6) as importance from theta group by feature"""))
def nb_importance(spark, sf):
    model, sets = fitted(spark, sf, "naive_bayes")
    return X.bayes_importance(spark, model, sets.features, sets.labels).select(
        "feature", F.round("importance", 6).alias("importance")
    )


@query("nb_priors", _bayes("""
select label::integer as label, name as label_name, round(v, 6) as log_prior, round(exp(v), 6) as prior from pi"""))
def nb_priors(spark, sf):
    model, sets = fitted(spark, sf, "naive_bayes")
    return X.bayes_priors(spark, model, sets.labels).select(
        "label", "label_name", F.round("log_prior", 6).alias("log_prior"), F.round("prior", 6).alias("prior")
    )


@query("nb_top_per_class", _bayes("""
select label::integer as label, name as label_name, feature, round(v, 6) as log_likelihood, "rank"::integer as "rank"
from (select *, row_number() over (partition by label order by v desc, feature) as "rank" from theta) where "rank" <= 5"""))
def nb_top_per_class(spark, sf):
    model, sets = fitted(spark, sf, "naive_bayes")
    return X.bayes_top_per_class(spark, model, sets.features, sets.labels).withColumn(
        "log_likelihood", F.round("log_likelihood", 6)
    )


_CLASS_HITS = """, hits as (select label, prediction, count(*) as n from best group by all),
t as (select label as c, sum(n) as t, sum(case when label = prediction then n else 0 end) as h from hits group by 1),
p as (select prediction as c, sum(n) as p from hits group by 1),
m as (select t, h, coalesce(h / p::double, 0) as pr, h / t::double as re, 2 * h / (t + coalesce(p, 0))::double as f1
  from t left join p using (c))
"""


@query("train_nb", _BAYES_SCORED + _CLASS_HITS + """
select sum(t)::bigint as n, round(sum(h) / sum(t)::double, 6) as accuracy, round(sum(f1 * t) / sum(t)::double, 6) as f1_score,
  round(sum(pr * t) / sum(t)::double, 6) as precision, round(sum(re * t) / sum(t)::double, 6) as recall from m""")
def train_nb(spark, sf):
    return _test_metrics(spark, sf, "naive_bayes")


@query("stream_score", _BAYES_SCORED + """, k as (select distinct rowno, flow_key from cells where not in_train)
select (1 + flow_key % 2)::integer as model_version, c.name as predicted_class, count(*) as n
from best join k using (rowno) join classes c on c.label = prediction group by 1, 2""")
def stream_score(spark, sf):
    """A stream scored by two versions: the second is published after the first half of the rows, by a refit that finds the same model."""
    model, sets = fitted(spark, sf, "naive_bayes")
    inbox, root, path = make_folder(spark, scratch_path(spark, "to-score")), scratch_path(spark, "versions"), scratch_path(spark, "scored")
    rows = M.split(M.prepare_multiclass(stored_gold(spark, sf), features=NUMERIC, keep=["flow_key"], weighted=False).data, ["flow_key"], 0.8, SEED)[1]
    stream = table_stream(spark, inbox, rows.schema)
    for half in (0, 1):
        scoring.publish(spark, model, root)
        rows.filter(F.col("flow_key") % 2 == half).write.mode("append").parquet(inbox)
        scoring.start_scoring(stream, root, path, f"{path}-checkpoint", sets.labels, ["flow_key"]).awaitTermination()
    return scoring.read_scored(spark, path).groupBy("model_version", "predicted_class").agg(F.count(F.lit(1)).alias("n"))


@query("cv_folds", with_gold(f""", {_CLASS_TABLE}
select label, cast(floor({draw('flow_key', SEED + 2)} * 3 / 4294967296) as integer) as fold, count(*) as n
from gold join classes on name = Attack_type where {TRAIN} group by 1, 2"""))
def cv_folds(spark, sf):
    """Rows per class and fold of a three-fold search: a key's rows share a fold, on every layout."""
    sets = M.training_set(stored_gold(spark, sf), ["flow_key"], features=NUMERIC, seed=SEED, persist=False)
    fold = models.fold_of(F.col(M.FOLD_DRAW), 3)
    return sets.train.groupBy("label", fold.alias("fold")).agg(F.count(F.lit(1)).alias("n"))


@query("score", _BAYES_SCORED + """
select c.name as predicted_class, count(*) as n from best join classes c on c.label = prediction group by 1""")
def score(spark, sf):
    model, sets = fitted(spark, sf, "naive_bayes")
    scored = models.score(sets.test, model, sets.labels)
    return scored.groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n"))
