"""Queries of aggregates, statistics, evaluation and monitoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.catalog.base import (
    hash_sql,
    LINE_FEATURES,
    NUMBERS_SQL,
    numbers,
    query,
    r6,
    table,
)
from linewatch.operators.anomaly import AnomalyModel, fit_mahalanobis, is_anomalous, mahalanobis_distance
from linewatch.operators.drift import (
    detect_drift,
    drift_per_message,
    feature_registry,
    warm_detectors,
)
from linewatch.operators.encode import Scaler, encode_categories, fit_categories, fit_labels, fit_one_hot, label_encode, one_hot
from linewatch.operators.evaluate import classification_report, confusion, macro_recall
from linewatch.operators.metrics import CONFIDENCE_BUCKETS, drifted_features, service_counters
from linewatch.operators.moments import CoMoments, co_moments, merged
from linewatch.operators.ordering import dense_index
from linewatch.operators.quantiles import exact_percentiles, medians
from linewatch.operators.sketches import merge_sketches, percentile_sketches, rank_error, sketched_percentiles
from linewatch.operators.stats import (
    covariance_rows,
    fit_scaler,
    mean_and_covariance,
    profile,
    rarest_class_size,
    reference_statistics,
    value_counts,
)
from linewatch.functions.labels import label_name
from linewatch.session import materialise, run_dir


def sql_rows(columns: list[str], row: str) -> str:
    """``row`` once per column, as one table."""
    return " union all ".join(row.format(c=c) for c in columns)


@query(
    "profile_o26",
    sql_rows(
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
        "select '{c}' as column_name, count(*) as rows, count({c}) as non_null, "
        "min({c})::varchar as min_value, max({c})::varchar as max_value from orders",
    )
    + """ union all select 'o_totalprice', count(*), count(o_totalprice), printf('%.2f', min(o_totalprice)), printf('%.2f', max(o_totalprice)) from orders
      union all select 'o_orderdate', count(*), count(o_orderdate), strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S'),
        strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') from orders""",
)
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    """All columns; the price is printed with two places, as its text differs between engines."""
    found = profile(table(spark, sf, "orders"))
    price = F.col("column_name") == "o_totalprice"

    def shown(c: str):
        return F.when(price, F.format_string("%.2f", F.col(c).try_cast("double"))).otherwise(F.col(c)).alias(c)

    return found.select("column_name", "rows", "non_null", shown("min_value"), shown("max_value"))


@query("value_counts_o30", "select event_type, count(*) as n from events group by event_type")
def counts(spark: SparkSession, sf: str) -> DataFrame:
    return value_counts(table(spark, sf, "events"), "event_type")


@query(
    "rarest_class_o31",
    "select min(n) as n from (select count(*) as n from lineitem group by l_returnflag)",
)
def rarest(spark: SparkSession, sf: str) -> DataFrame:
    return rarest_class_size(table(spark, sf, "lineitem"), "l_returnflag")


@query(
    "medians_o32",
    sql_rows(LINE_FEATURES, "select '{c}' as feature, round(median({c}), 6) as median from lineitem")
    + """ union all select 'half_bad', round(coalesce(median(try_cast(case when l_linenumber % 2 = 0 then 'bad'
      else l_quantity::varchar end as double)), 0), 6) from lineitem
      union all select 'all_bad', 0.0""",
)
def column_medians(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr(
        *LINE_FEATURES,
        "case when l_linenumber % 2 = 0 then 'bad' else cast(l_quantity as string) end as half_bad",
        "'bad' as all_bad",
    )
    found = medians(lines, lines.columns)
    return spark.createDataFrame(list(found.items()), "feature string, median double").select(
        "feature", r6("median").alias("median")
    )


@query(
    "fit_scaler_o33",
    sql_rows(
        LINE_FEATURES,
        "select '{c}' as feature, round(avg({c}), 4) as mean, round(stddev_pop({c}), 4) as std from lineitem",
    ),
)
def scaler_fit(spark: SparkSession, sf: str) -> DataFrame:
    fitted = fit_scaler(table(spark, sf, "lineitem"), LINE_FEATURES)
    return fitted.select("feature", r6("mean", 4).alias("mean"), r6("std", 4).alias("std"))


@query(
    "reference_statistics_o34",
    sql_rows(
        LINE_FEATURES,
        "select '{c}' as feature, round(avg({c}), 4) as mean, round(greatest(stddev_pop({c}), 1e-6), 6) as std, "
        "min({c}) as min, max({c}) as max, count({c}) as count from lineitem",
    )
    + """ union all select 'constant', 7.0, 1e-6, 7.0, 7.0, count(*) from lineitem
      union all select 'odd', round(avg(l_tax), 4), round(stddev_pop(l_tax), 6), min(l_tax), max(l_tax), count(*)
        from lineitem where l_linenumber % 3 = 0
      union all select 'empty', 0.0, 1.0, 0.0, 1.0, 0""",
)
def reference_stats(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr(
        *LINE_FEATURES,
        "7.0D as constant",
        "case l_linenumber % 3 when 0 then l_tax when 1 then double('NaN') else double('infinity') end as odd",
        "double('NaN') as empty",
    )
    stats = reference_statistics(lines, lines.columns)
    return stats.select("feature", r6("mean", 4).alias("mean"), r6("std").alias("std"), "min", "max", "count")


@query(
    "covariance_o35",
    " union all ".join(
        f"select '{a}' as feature_a, '{b}' as feature_b, round(covar_samp({a}, {b}), 3) + 0.0 as cov from lineitem"
        for i, a in enumerate(LINE_FEATURES)
        for b in LINE_FEATURES[i:]
    ),
)
def covariances(spark: SparkSession, sf: str) -> DataFrame:
    rows = covariance_rows(table(spark, sf, "lineitem"), LINE_FEATURES)
    return rows.select("feature_a", "feature_b", r6("cov", 3).alias("cov"))


SCALED_SQL = """z as (select (l_quantity - qm) / qs as q, (l_discount - dm) / ds as d from lineitem,
  (select avg(l_quantity) as qm, stddev_pop(l_quantity) as qs, avg(l_discount) as dm, stddev_pop(l_discount) as ds from lineitem))"""


def scaled_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return Scaler.fit(lines, ["l_quantity", "l_discount"]).transform(lines)


@query(
    "merged_moments_o35",
    """with l as (select l_quantity as a, case when l_linenumber = 3 then null else l_discount end as b, l_tax as c from lineitem where l_linenumber <> 3)
      select 'a' as x, 'b' as y, count(*) as n, round(avg(a), 6) as mean_x, round(covar_samp(a, b), 6) as cov from l
      union all select 'b', 'c', count(*), round(avg(b), 6), round(covar_samp(b, c), 6) from l
      union all select 'c', 'c', count(*), round(avg(c), 6), round(var_samp(c), 6) from l""",
)
def merged_moments(spark: SparkSession, sf: str) -> DataFrame:
    """Moments of three parts of a table, fitted apart, saved as text and merged; rows with a null take no part."""
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey % 3 as part", "l_quantity as a", "if(l_linenumber = 3, null, l_discount) as b", "l_tax as c")
    names = ["a", "b", "c"]
    saved = [co_moments(lines.where(F.col("part") == p), names).to_json() for p in range(3)]
    held = merged(map(CoMoments.from_json, saved), 3)
    cov = held.covariance()
    rows = [(x, y, held.n, round(held.mean[names.index(x)], 6), round(cov[names.index(x)][names.index(y)], 6) + 0.0) for x, y in ("ab", "bc", "cc")]
    return spark.createDataFrame(rows, "x string, y string, n bigint, mean_x double, cov double")


@query(
    "covariance_matrix_o35",
    f"""with {SCALED_SQL} select 0 as i, 0 as j, round(var_samp(q), 6) + 0.0 as cov from z
      union all select 0, 1, round(covar_samp(q, d), 6) + 0.0 from z
      union all select 1, 0, round(covar_samp(q, d), 6) + 0.0 from z
      union all select 1, 1, round(var_samp(d), 6) + 0.0 from z""",
)
def covariance_matrix(spark: SparkSession, sf: str) -> DataFrame:
    _, cov = mean_and_covariance(scaled_lines(spark, sf), ["l_quantity", "l_discount"])
    rows = [(i, j, cov[i][j]) for i in range(2) for j in range(2)]
    return spark.createDataFrame(rows, "i int, j int, cov double").select("i", "j", r6("cov").alias("cov"))


@query(
    "percentile_o36",
    sql_rows(
        LINE_FEATURES,
        "select '{c}' as feature, round(quantile_cont({c}, 0.99), 6) as p99 from lineitem",
    ),
)
def percentile(spark: SparkSession, sf: str) -> DataFrame:
    found = exact_percentiles(table(spark, sf, "lineitem"), LINE_FEATURES, 0.99)
    return spark.createDataFrame(list(found.items()), "feature string, p99 double").select(
        "feature", r6("p99").alias("p99")
    )


@query(
    "sketched_percentiles_o36",
    sql_rows(LINE_FEATURES, "select '{c}' as feature, share::double as share, count(*) as n, true as within from lineitem, (values (0.5), (0.99)) s(share) group by share"),
)
def sketched(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles from sketches of three parts of a table, stored and merged: does the rank of each lie within the stated error, twice, of the wanted one?"""
    lines = table(spark, sf, "lineitem")
    path = run_dir(spark, "sketches")
    for part in range(3):
        percentile_sketches(lines.where(F.col("l_orderkey") % 3 == part), LINE_FEATURES).write.mode("append").parquet(path)
    stored = materialise(spark, merge_sketches(spark.read.parquet(path)), "merged")
    values = [(c, share, v) for share in (0.5, 0.99) for c, v in sketched_percentiles(stored, share).items()]
    ranks = lines.agg(
        *[F.array(F.avg((F.col(c) < v).cast("int")), F.avg((F.col(c) <= v).cast("int"))).alias(f"r{i}") for i, (c, _, v) in enumerate(values)]
    )
    slack = 2 * rank_error()
    rows = [
        F.struct(F.lit(c).alias("feature"), F.lit(share).alias("share"), F.lit(share).between(F.col(f"r{i}")[0] - slack, F.col(f"r{i}")[1] + slack).alias("within"))
        for i, (c, share, _) in enumerate(values)
    ]
    sizes = stored.select(F.col("column").alias("feature"), "n")
    return ranks.select(F.inline(F.array(*rows))).join(sizes, "feature").select("feature", "share", "n", "within")


SCORES_SQL = """counts as (select {label} as l, {prediction} as p, count(*) as n from {table} group by all),
  classes as (select l as c from counts union select p from counts),
  sums as (select c, coalesce((select sum(n) from counts where l = c), 0)::bigint as support,
    coalesce((select sum(n) from counts where p = c), 0)::bigint as predicted,
    coalesce((select sum(n) from counts where p = c and l = c), 0)::bigint as hits from classes),
  pr as (select *, case when predicted > 0 then hits / predicted else 0 end as precision,
    case when support > 0 then hits / support else 0 end as recall from sums),
  scores as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1 from pr)"""

REPORT_SQL = """select c::varchar as class_name, round(precision, 6) as precision, round(recall, 6) as recall,
    round(f1, 6) as f1, support from scores
  union all select 'accuracy', null, null, round(sum(hits) / sum(support), 6), sum(support)::bigint from scores
  union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint from scores
  union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
    round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from scores"""


def rounded_report(counts: DataFrame) -> DataFrame:
    return classification_report(counts).select(
        "class_name", *[r6(m).alias(m) for m in ("precision", "recall", "f1")], "support"
    )


@query(
    "classification_report_o37",
    f"with {SCORES_SQL.format(label='quality', prediction='toxic', table='labels')} {REPORT_SQL}",
)
def report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_report(confusion(table(spark, sf, "labels"), "quality", "toxic"))


@query(
    "classification_report_uneven_o37",
    f"with {SCORES_SQL.format(label='l_returnflag', prediction='l_linestatus', table='lineitem')} {REPORT_SQL}",
)
def report_uneven(spark: SparkSession, sf: str) -> DataFrame:
    """Classes that are never predicted, and predictions that are never true."""
    return rounded_report(confusion(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"))


@query(
    "macro_recall_o38",
    f"with {SCORES_SQL.format(label='quality', prediction='toxic', table='labels')} "
    "select round(avg(recall), 6) as macro_recall from scores",
)
def recall(spark: SparkSession, sf: str) -> DataFrame:
    counts = confusion(table(spark, sf, "labels"), "quality", "toxic")
    return macro_recall(counts).select(r6("macro_recall").alias("macro_recall"))


SCORED_EXPR = {
    "seq": "event_id",
    "confidence": "1 / (1 + value)",
    "is_anomaly": "value > 200",
}


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        *[f"{e} as {n}" for n, e in SCORED_EXPR.items()],
        "filter(array(case when value > 150 then 'Torque(Nm)' end, case when user_id % 11 = 0 then 'Tool(?m)' end), "
        "x -> x is not null) as drifted_features",
    )


SCORED_SQL = """s as (select event_id as seq, 1 / (1 + value) as confidence, value > 200 as is_anomaly,
  (case when value > 150 then 1 else 0 end + case when user_id % 11 = 0 then 1 else 0 end) as n from events)"""


def _bucket_sql(le: float) -> str:
    name = "+Inf" if le == float("inf") else str(le)
    where = "true" if le == float("inf") else f"confidence <= {le}"
    return (
        f"select 'prediction_confidence_bucket_le_{name}' as metric, "
        f"count(*) filter ({where})::double as value from s"
    )


@query(
    "service_counters_o39",
    f"with {SCORED_SQL} "
    + " union all ".join(_bucket_sql(le) for le in CONFIDENCE_BUCKETS)
    + """ union all select 'predictions_total', count(*)::double from s
      union all select 'drift_detected_total', count(*) filter (n > 0)::double from s
      union all select 'anomalies_detected_total', count(*) filter (is_anomaly)::double from s
      union all select 'prediction_confidence_count', count(*)::double from s
      union all select 'prediction_confidence_sum', round(sum(confidence), 4) from s
      union all select 'drifted_features_count', max_by(n, seq)::double from s
      union all select 'model_health_status', 1.0""",
)
def counters(spark: SparkSession, sf: str) -> DataFrame:
    return service_counters(scored(spark, sf)).select("metric", r6("value", 4).alias("value"))


@query(
    "drifted_features_o39",
    """select 'feature_drift_Torque_Nm_' as metric, 1.0::double as value where exists (select 1 from events where value > 150)
      union all select 'feature_drift_Tool__m_', 1.0::double where exists (select 1 from events where user_id % 11 = 0)""",
)
def drift_gauges(spark: SparkSession, sf: str) -> DataFrame:
    return drifted_features(scored(spark, sf))


MODEL_SQL = """f as (select l_quantity as x, l_extendedprice as y from lineitem),
  c as (select avg(x) as mx, avg(y) as my, var_samp(x) as a, covar_samp(x, y) as b, var_samp(y) as d from f),
  i as (select mx, my, d / (a * d - b * b) as ia, -b / (a * d - b * b) as ib, a / (a * d - b * b) as id from c),
  d2 as (select x, y, (x - mx) * ia * (x - mx) + 2 * (x - mx) * ib * (y - my) + (y - my) * id * (y - my) as d2 from f, i),
  t as (select quantile_cont(d2, 0.99) as threshold from d2)"""
PAIR = ["l_quantity", "l_extendedprice"]


def pair_model(spark: SparkSession, sf: str) -> tuple[DataFrame, AnomalyModel]:
    lines = table(spark, sf, "lineitem").select(*PAIR)
    return lines, fit_mahalanobis(lines, PAIR)


@query(
    "fit_mahalanobis_o52",
    f"""with {MODEL_SQL} select round(mx, 4) as mean_x, round(my, 4) as mean_y, round(ia, 9) as xx, round(ib, 12) + 0.0 as xy,
      round(id, 15) as yy, round(threshold, 6) as threshold from i, t""",
)
def fit_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    _, m = pair_model(spark, sf)
    row = (*m.mean, m.cov_inv[0][0], m.cov_inv[0][1], m.cov_inv[1][1], m.threshold)
    fitted = spark.createDataFrame(
        [row], "mean_x double, mean_y double, xx double, xy double, yy double, threshold double"
    )
    digits = {"mean_x": 4, "mean_y": 4, "xx": 9, "xy": 12, "yy": 15, "threshold": 6}
    return fitted.select(*[r6(c, d).alias(c) for c, d in digits.items()])


@query(
    "mahalanobis_distance_o53",
    f"with {MODEL_SQL} select x as l_quantity, y as l_extendedprice, round(d2, 5) + 0.0 as d2 from d2",
)
def distances(spark: SparkSession, sf: str) -> DataFrame:
    lines, m = pair_model(spark, sf)
    return lines.select(*PAIR, r6(mahalanobis_distance([F.col(c) for c in PAIR], m), 5).alias("d2"))


@query(
    "mahalanobis_wide_o53",
    """with e as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings)
      select vec_id, round(sum((x - i / 1000.0) * (x - i / 1000.0) * i), 4) as d2 from e group by vec_id""",
)
def wide_distances(spark: SparkSession, sf: str) -> DataFrame:
    """64 features through the Arrow form, against a diagonal model."""
    size = 64
    model = AnomalyModel(
        [(i + 1) / 1000.0 for i in range(size)],
        [[float(i + 1) if i == j else 0.0 for j in range(size)] for i in range(size)],
    )
    parts = [F.col("embedding")[i].cast("double") for i in range(size)]
    return table(spark, sf, "embeddings").select(
        "vec_id", r6(mahalanobis_distance(parts, model), 4).alias("d2")
    )


@query(
    "is_anomalous_o54",
    f"with {MODEL_SQL} select x as l_quantity, y as l_extendedprice, d2 > threshold as anomalous from d2, t",
)
def anomalies(spark: SparkSession, sf: str) -> DataFrame:
    lines, m = pair_model(spark, sf)
    distance = mahalanobis_distance([F.col(c) for c in PAIR], m)
    return lines.select(*PAIR, is_anomalous(distance, m.threshold).alias("anomalous"))


# A series that steps between two levels every STEP values: the detector sees it at the end of the first block after the step.
STEP = 160
SEEN = "{p} >= {step} and {p} % {step} = 31"


@query(
    "detect_drift_o55",
    f"""with p as (select event_id, user_id % 4 as machine, row_number() over (partition by user_id % 4 order by event_id) - 1 as p from events)
      select machine::varchar as machine, 'x' as feature, event_id as seq from p where {SEEN.format(p="p", step=STEP)}
      union all select machine::varchar, 'y', event_id from p where {SEEN.format(p="p", step=2 * STEP)}""",
)
def drift(spark: SparkSession, sf: str) -> DataFrame:
    """Each machine's own stepping series, and a constant that never drifts."""
    rows = table(spark, sf, "events").selectExpr("event_id as row_id", "user_id % 4 as machine")
    placed = dense_index(rows, by=["machine"], out="p").selectExpr(
        "row_id", "machine", f"(p div {STEP}) % 2 * 10D as x", f"(p div {2 * STEP}) % 2 * -3D as y", "7D as z"
    )
    return detect_drift(placed, ["x", "y", "z"], by=["machine"]).select("machine", "feature", "seq")


@query(
    "detect_drift_short_steps_o55",
    """with p as (select event_id, user_id % 4 as machine, row_number() over (partition by user_id % 4 order by event_id) - 1 as p from events)
      select machine::varchar as machine, 'x' as feature, event_id as seq from p where p >= 63 and p % 32 = 31 and p % 160 <> 159""",
)
def drift_short(spark: SparkSession, sf: str) -> DataFrame:
    """Steps every 40 values, which only sides shorter than a look apart can tell: four looks of five find one."""
    rows = table(spark, sf, "events").selectExpr("event_id as row_id", "user_id % 4 as machine")
    placed = dense_index(rows, by=["machine"], out="p").selectExpr("row_id", "machine", "(p div 40) % 2 * 10D as x", "7D as z")
    return detect_drift(placed, ["x", "z"], by=["machine"]).select("machine", "feature", "seq")


@query(
    "drift_per_message_o56",
    f"""with f as (select event_id as seq, {SEEN.format(p="event_id", step=STEP)} as x, {SEEN.format(p="event_id", step=2 * STEP)} as y from events)
      select seq, x or y as drift_detected, case when x and y then 'x,y' when x then 'x' when y then 'y' else '' end as features from f""",
)
def drift_roll_up(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").selectExpr(
        "event_id as row_id", f"(event_id div {STEP}) % 2 * 10D as x", f"(event_id div {2 * STEP}) % 2 * -3D as y", "7D as z"
    )
    rolled = drift_per_message(detect_drift(rows, ["x", "y", "z"]), rows.withColumnRenamed("row_id", "seq"))
    return rolled.select("seq", "drift_detected", F.array_join("drifted_features", ",").alias("features"))


@query(
    "drift_per_message_given_o56",
    f"""with {NUMBERS_SQL} select row_id as seq, s1 > 100 or s2 > 90 as drift_detected,
      list_filter(['s1', 's2'], lambda x: (x = 's1' and s1 > 100) or (x = 's2' and s2 > 90))::varchar as features from numbers""",
)
def drift_roll_up_given(spark: SparkSession, sf: str) -> DataFrame:
    """The roll-up alone, on flags that SQL can compute."""
    df = numbers(spark, sf)
    flags = df.select(
        F.col("row_id").alias("seq"),
        F.inline(
            F.array(
                F.struct(F.lit("s1").alias("feature"), (F.col("s1") > 100).alias("newly_drifted")),
                F.struct(F.lit("s2").alias("feature"), (F.col("s2") > 90).alias("newly_drifted")),
            )
        ),
    )
    rolled = drift_per_message(flags.where("newly_drifted"), df.withColumnRenamed("row_id", "seq"))
    listed = F.concat(F.lit("["), F.array_join("drifted_features", ", "), F.lit("]"))
    return rolled.select("seq", "drift_detected", listed.alias("features"))


@query(
    "warm_detectors_o57",
    f"""with {NUMBERS_SQL}, sample as (select * from numbers order by {hash_sql(42, "row_id")}, row_id limit 1000)
      select 's2' as feature, count(*) as seen, round(sum(s2), 4) as total, false as drifted from sample
      union all select 'constant', count(*), round(sum(7.0::double), 4), false from sample""",
)
def warm(spark: SparkSession, sf: str) -> DataFrame:
    """How many values the detectors have seen, and their sum: that of the hash-ordered sample."""
    states = warm_detectors(numbers(spark, sf).withColumn("constant", F.lit(7.0)), ["s2", "constant"])
    parsed = states.select("feature", F.from_json("state", "sum double, drifted boolean, seen bigint").alias("s"))
    return parsed.select("feature", F.col("s.seen").alias("seen"), r6(F.col("s.sum"), 4).alias("total"), F.col("s.drifted").alias("drifted"))


@query(
    "feature_registry_o59",
    """select 0 as position, 'l_quantity' as feature, round(avg(l_quantity), 4) as mean, round(stddev_pop(l_quantity), 6) as std,
        min(l_quantity) as min, max(l_quantity) as max, count(*) as count from lineitem
      union all select 1, 'new_feature', 0.0, 1.0, 0.0, 1.0, 0
      union all select 2, 'l_tax', round(avg(l_tax), 4), round(stddev_pop(l_tax), 6), min(l_tax), max(l_tax), count(*) from lineitem""",
)
def registry(spark: SparkSession, sf: str) -> DataFrame:
    saved = reference_statistics(table(spark, sf, "lineitem"), ["l_tax", "l_quantity"])
    known = feature_registry(spark, ["l_quantity", "new_feature", "l_tax"], saved)
    return known.select(
        "position", "feature", r6("mean", 4).alias("mean"), r6("std").alias("std"), "min", "max", "count"
    )


@query(
    "label_encode_o70",
    "select event_id, (dense_rank() over (order by event_type) - 1)::int as class_id from events",
)
def encode(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type")
    coded, _ = label_encode(events, "event_type")
    return coded.select("event_id", F.col("event_type").alias("class_id"))


@query(
    "label_name_o71",
    """with c as (select event_type, row_number() over (order by event_type) - 1 as id from (select distinct event_type from events))
      select event_id, coalesce(c.event_type, concat('Unknown_Class_', user_id % 9 - 1)) as name
      from events e left join c on c.id = e.user_id % 9 - 1""",
)
def decode_label(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    classes = fit_labels(events, "event_type")
    return events.select("event_id", label_name(F.col("user_id") % 9 - 1, classes).alias("name"))


@query(
    "one_hot_o72",
    "select event_id, "
    + ", ".join(
        f"(event_type = '{t}')::int::double as event_type_{t}"
        for t in ("click", "error", "purchase", "signup", "view")
    )
    + ", "
    + ", ".join(f"(user_id % 3 = {i})::int::double as line_{i}" for i in range(3))
    + " from events",
)
def dummies(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").selectExpr("event_id", "event_type", "user_id % 3 as line")
    return one_hot(events, fit_one_hot(events, ["event_type", "line"]))


@query(
    "category_vectors_o72",
    f"""with l as (select l_orderkey, coalesce(case when l_linenumber < 7 then l_partkey end::varchar, 'nan') as part, l_suppkey::varchar as supp from lineitem),
      fit as (select distinct 'part' as name, part as value from l where l_orderkey % 4 > 0 union select distinct 'supp', supp from l where l_orderkey % 4 > 0),
      placed as (select name, value, row_number() over (partition by name order by {hash_sql(0, "value")}, value) - 1 as position from fit),
      cells as (select name, value from (select 'part' as name, part as value from l union all select 'supp', supp from l)),
      wide as (select count(*) as n from placed where name = 'part')
      select case when p.name = 'part' then 0 else wide.n end + position as position, count(*) as n
      from cells c join placed p on p.name = c.name and p.value = c.value, wide group by all""",
)
def category_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Rows at each position of the vectors of two columns of many values, some of which the fit has not seen."""
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey", "if(l_linenumber < 7, l_partkey, null) as part", "l_suppkey as supp")
    fitted = fit_categories(lines.where("l_orderkey % 4 > 0"), ["part", "supp"])
    vectors = encode_categories(lines, fitted)
    total = vectors.select(vector_to_array(Summarizer.sum(F.col("categories"))).alias("sums"))
    counted = total.select(F.posexplode("sums").alias("position", "n")).where("n > 0")
    return counted.select(F.col("position").cast("bigint").alias("position"), F.col("n").cast("bigint").alias("n"))


@query(
    "scale_o73",
    """with s as (select avg(l_quantity) as qm, stddev_pop(l_quantity) as qs, avg(l_tax) as tm, stddev_pop(l_tax) as ts from lineitem)
      select l_orderkey, round((l_quantity - qm) / qs, 6) + 0.0 as l_quantity, round((l_tax - tm) / ts, 6) + 0.0 as l_tax,
      0.0::double as constant from lineitem, s""",
)
def scale(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_quantity", "l_tax", "7.0D as constant")
    scaled = Scaler.fit(lines, ["l_quantity", "l_tax", "constant"]).transform(lines)
    return scaled.select("l_orderkey", *[r6(c).alias(c) for c in ("l_quantity", "l_tax", "constant")])
