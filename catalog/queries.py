"""Registered queries: one library operator each, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.views import stored_views, view
from loanweave.functions import expressions as X
from loanweave.functions.roles import matching, numeric_columns, text_columns
from loanweave.operators import aggregates as A
from loanweave.operators import checks, cleaning, profile
from loanweave.operators import training as M
from loanweave.operators.joins import attach, left_join
from loanweave.operators.modes import frequent_mode_table, mode_table
from loanweave.operators.quantiles import quantiles
from loanweave.plans import cleaning_presets as presets
from loanweave.plans import features, prepare
from loanweave.sources.readers import read_csv, rejected_cells
from loanweave.sources.staging import stage, stage_all, staging_path
from loanweave.sources.tables import TABLES, load_existing, read_raw
from loanweave.sources.writers import load_model, write_counted, write_csv, write_features, write_parquet

Query = Callable[[SparkSession, str], DataFrame]

APP, DAYS, AMOUNTS = "app_id", ("days_*",), ("amt_*",)
VIEWS = ("v_app", "v_app_test", "v_bureau", "v_balance", "v_prev", "v_inst", "v_card", "v_pos")
DATED = ("v_app", "v_app_test", "v_bureau", "v_prev", "v_inst")
PRICED = ("v_app", "v_app_test", "v_bureau", "v_prev", "v_inst", "v_card")
# Table that each view stands for, and columns of the cleaned view.
ROLES = {
    "app_train": ("v_app", 13), "app_test": ("v_app_test", 12), "bureau": ("v_bureau", 6), "bureau_bal": ("v_balance", 3),
    "prev_app": ("v_prev", 7), "pos_cash": ("v_pos", 4), "credit_card": ("v_card", 5), "installments": ("v_inst", 6),
}
DROPPED = {"app_train": ("car_age",), "app_test": ("car_age",), "bureau": ("amt_overdue",), "prev_app": ("days_first_drawing",)}
ACCEPTABLE = ("app_train", "app_test", "prev_app")
EXACT = {"rel_error": 0.0}  # the SQL side computes exact quantiles

# Roll-ups in the names of the test views. Sums of money are exact decimals: two places
# as stored, four where a price is multiplied by a discount.
BUREAU = A.bureau_rollup(APP, "bureau_id", "amt_credit_sum", "amt_credit_sum_debt", "days_credit", "credit_active", scale=2)
BALANCE = A.balance_rollup("bureau_id", "months_balance", "status")
BALANCE_PARTS = A.balance_parts_rollup("bureau_id", "months_balance", "status")
BALANCE_SECOND = A.balance_second_level(APP, "bureau_id")
PREVIOUS = A.previous_rollup(APP, "prev_id", "amt_application", "amt_credit", "contract_status", scale=2)
INSTALLMENTS = A.installments_rollup(APP, "prev_id", "amt_instalment", "amt_payment", "days_instalment", "days_entry_payment", scale=4)
CARD = A.card_rollup(APP, "amt_balance", "amt_credit_limit", "cnt_drawings", scale=2)
POS = A.pos_rollup(APP, "prev_id", "cnt_instalment", "contract_status")
ROLLUPS = {"v_bureau": BUREAU, "v_prev": PREVIOUS, "v_inst": INSTALLMENTS, "v_card": CARD, "v_pos": POS}

APPLICATION = presets.application(
    days=DAYS,
    employed="days_employed",
    amounts=("amt_income", "amt_credit", "amt_annuity"),
    children="cnt_children",
    car_age="vehicle_age",
    **EXACT,
)
SPECS = {
    "v_app": APPLICATION,
    "v_app_test": APPLICATION,
    "v_bureau": presets.bureau(DAYS, **EXACT),
    "v_balance": presets.bureau_balance("status", **EXACT),
    "v_prev": presets.previous_application(DAYS, **EXACT),
    "v_inst": presets.installments(("amt_payment", "amt_instalment"), DAYS, **EXACT),
    "v_card": presets.credit_card(**EXACT),
    "v_pos": presets.pos_cash(**EXACT),
}
JOINED = ("v_inst", "v_pos")  # views over a join: stored once before several scans


def on_view(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(view(spark, sf, name))


def cleaned(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = view(spark, sf, name)
        return cleaning.clean(stage(raw, name) if name in JOINED else raw, SPECS[name])

    return run


def final_features(strategy: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        names = ("v_app", *ROLLUPS)
        return features.final_features(
            {n: view(spark, sf, n) for n in names}, ROLLUPS, "v_app", APP, strategy
        )

    return run


def final_features_with_balance(spark: SparkSession, sf: str) -> DataFrame:
    tables = {n: view(spark, sf, n) for n in ("v_app", "v_balance", *ROLLUPS)}
    return features.final_features(
        tables, ROLLUPS, "v_app", APP, "shuffle", with_balance=True,
        balance_rollups=(BALANCE_PARTS, BALANCE_SECOND), side_names=("v_bureau", "v_balance"),
    )


def join_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """A base of which one key holds a third of the rows and NULL a tenth, joined with splitting on."""
    skewed = f"CASE WHEN prev_id % 3 = 0 THEN 1 WHEN prev_id % 7 = 0 THEN NULL ELSE {APP} END AS {APP}"
    base = view(spark, sf, "v_pos").selectExpr(skewed, "prev_id", "cnt_instalment")
    sides = [BUREAU(view(spark, sf, "v_bureau")), CARD(view(spark, sf, "v_card"))]
    return attach(base, sides, APP, "shuffle", hot_share=0.05)


def join_skewed_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """The same base with a side that repeats its keys, hot ones included: too large to broadcast, so salted."""
    skewed = f"CASE WHEN prev_id % 3 = 0 THEN 1 WHEN prev_id % 7 = 0 THEN NULL ELSE {APP} END AS {APP}"
    base = view(spark, sf, "v_pos").selectExpr(skewed, "prev_id", "cnt_instalment")
    side = view(spark, sf, "v_bureau").selectExpr(APP, "bureau_id", "credit_active")
    return attach(base, [side], APP, "shuffle", limit=0, hot_share=0.05)


def final_features_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    tables = {n: view(spark, sf, n) for n in ("v_app", *ROLLUPS)}
    base, sides = features.bucketed_inputs(tables, staging_path(spark, "buckets"), ROLLUPS, "v_app", APP, 8)
    return attach(base, sides, APP, "shuffle")


def join_variants(spark: SparkSession, sf: str) -> DataFrame:
    """The join of all roll-ups by either strategy: rows, and whether the plan broadcasts."""
    sides = stage_all([rollup(view(spark, sf, name)) for name, rollup in ROLLUPS.items()], "side")
    timed = features.compare_strategies(view(spark, sf, "v_app"), sides, APP)
    return timed.select(F.col("strategy").alias("variant"), "rows", "plan_has_broadcast")


def default_rollups(spark: SparkSession, sf: str) -> DataFrame:
    """The roll-ups as shipped, which add doubles of unknown scale: are they close to the exact
    ones, key by key, and equal when the rows come in another order and partitioning?"""
    shipped = {
        "v_bureau": A.bureau_rollup(APP, "bureau_id", "amt_credit_sum", "amt_credit_sum_debt", "days_credit", "credit_active"),
        "v_prev": A.previous_rollup(APP, "prev_id", "amt_application", "amt_credit", "contract_status"),
        "v_inst": A.installments_rollup(APP, "prev_id", "amt_instalment", "amt_payment", "days_instalment", "days_entry_payment"),
        "v_card": A.card_rollup(APP, "amt_balance", "amt_credit_limit", "cnt_drawings"),
    }
    out = None
    for name, rollup in shipped.items():
        data = view(spark, sf, name)
        plain, exact = rollup(data).alias("a"), ROLLUPS[name](data).alias("b")
        values = [c for c in plain.columns if c != APP]
        gap = [F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= 1e-9 * F.greatest(F.abs(f"b.{c}"), F.lit(1.0)) for c in values]
        same = [g | (F.col(f"a.{c}").isNull() & F.col(f"b.{c}").isNull()) for g, c in zip(gap, values)]
        close = F.coalesce(F.forall(F.array(*same), lambda x: x), F.lit(False)).alias("close")
        dealt = rollup(data.repartition(7, F.xxhash64(*data.columns)).sortWithinPartitions(F.desc(data.columns[-1])))
        again = dealt.select(APP, F.struct(*values).alias("again"))
        same = F.struct(*[F.col(f"a.{c}") for c in values]).eqNullSafe(F.col("again")).alias("same")
        one = plain.join(exact, APP).join(again, APP).select(F.lit(name).alias("view"), APP, close, same)
        out = one if out is None else out.unionByName(one)
    return out


DEBTS = ("amt_credit_sum", "amt_credit_sum_debt", "amt_overdue")


def default_medians(spark: SparkSession, sf: str) -> DataFrame:
    """Medians at the rank errors that the presets ship with: is the value's rank near enough?"""
    data = view(spark, sf, "v_bureau")
    return _near(data, lambda error: {c: v[0] for c, v in quantiles(data, {c: [0.5] for c in DEBTS}, rel_error=error).items()})


def default_medians_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The same for medians that are read off sketches made in the scan that counts gaps."""
    data = view(spark, sf, "v_bureau")
    spec = cleaning.CleaningSpec(numeric_fill=DEBTS, text_fill=None, sketch=True)
    return _near(data, lambda error: replace(spec, rel_error=error).fit(data).fills)


def _near(data: DataFrame, medians: Callable[[float], dict]) -> DataFrame:
    out = []
    for error in (0.01, 0.001):
        found = medians(error)
        ranks = []
        for c in DEBTS:
            value = F.lit(found[c])
            low = F.count_if(F.col(c) < value) <= (0.5 + error) * F.count(c) + 1
            high = F.count_if(F.col(c) <= value) >= (0.5 - error) * F.count(c) - 1
            ranks.append(F.struct(F.lit(c).alias("column"), F.lit(error).alias("rel_error"), (low & high).alias("near")))
        out.append(data.agg(F.array(*ranks).alias("r")).select(F.inline("r")))
    return out[0].unionByName(out[1])


def one_left_join(spark: SparkSession, sf: str) -> DataFrame:
    return left_join(view(spark, sf, "v_app"), CARD(view(spark, sf, "v_card")), APP, "broadcast")


def bureau_with_balance(spark: SparkSession, sf: str) -> DataFrame:
    return features.loans_with_balance(view(spark, sf, "v_bureau"), view(spark, sf, "v_balance"), BALANCE)


def enrich_side_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.balance_features(
        view(spark, sf, "v_bureau"), view(spark, sf, "v_balance"), BALANCE_PARTS, BALANCE_SECOND
    )


# Profiles


def null_profile(df: DataFrame) -> DataFrame:
    return profile.null_counts(df).select("column", "rows", "nulls")


def sentinel_profile(df: DataFrame) -> DataFrame:
    return profile.sentinel_counts(df, matching(df.columns, DAYS))


def sentinel_one_column(df: DataFrame) -> DataFrame:
    return profile.sentinel_counts(df, ["days_employed"], keep_zero=True)


def over_views(names: tuple[str, ...], report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: profile.over_tables({n: view(spark, sf, n) for n in names}, report)


def sign_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Positive day offsets of all views that have some; negative amounts of bureau and instalments."""
    positive = over_views(DATED, lambda df: profile.positive_counts(df, matching(df.columns, DAYS)))(spark, sf)
    negative = over_views(("v_bureau", "v_inst"), lambda df: profile.negative_counts(df, matching(df.columns, AMOUNTS)))(spark, sf)
    tagged = [positive.withColumn("sign", F.lit("positive")), negative.withColumn("sign", F.lit("negative"))]
    return tagged[0].unionByName(tagged[1]).select("table", "column", "sign", "hits", "rows")


def amount_range(df: DataFrame) -> DataFrame:
    return profile.amount_ranges(df, matching(df.columns, AMOUNTS), scale=4)


def quartiles(df: DataFrame) -> DataFrame:
    names = matching(df.columns, AMOUNTS)
    found = quantiles(df, {c: [0.25, 0.5, 0.75] for c in names})
    rows = [(c, *found[c]) for c in names]
    return df.sparkSession.createDataFrame(rows, "column STRING, q1 DOUBLE, median DOUBLE, q3 DOUBLE")


def mode_profile(df: DataFrame) -> DataFrame:
    return mode_table(df, text_columns(df.schema))


def mode_profile_candidates(df: DataFrame) -> DataFrame:
    """The same modes through candidates; beside them a column of distinct values, which is counted in full."""
    wide = df.withColumn("distinct_code", F.concat(F.lit("p"), F.col("prev_id").cast("string")))
    return frequent_mode_table(wide, text_columns(wide.schema))


def table_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_summary({n: view(spark, sf, n) for n in VIEWS})


def null_cells(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_cells({n: view(spark, sf, n) for n in VIEWS}, ("v_app", "v_app_test", "v_prev"))


def null_reduction(spark: SparkSession, sf: str) -> DataFrame:
    raw = stored_views(spark, sf, VIEWS)
    return profile.null_reduction(raw, {n: cleaning.clean(raw[n], SPECS[n]) for n in VIEWS})


# Single repairs


def fix_sentinel(df: DataFrame) -> DataFrame:
    days = matching(df.columns, DAYS)
    return df.withColumns({c: F.expr(X.nullify(X.quoted(c), profile.SENTINEL)) for c in days})


def fix_positive_days(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.expr(X.flip_positive(X.quoted(c))) for c in matching(df.columns, DAYS)})


def fix_negative_amount(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.expr(X.null_negative(X.quoted(c))) for c in ("amt_payment", "amt_instalment")})


def filter_birth(df: DataFrame) -> DataFrame:
    return df.where(F.col("days_birth") < 0)


def reset_range(df: DataFrame) -> DataFrame:
    return df.withColumn("cnt_children", F.expr(X.reset_outside("cnt_children", 0, 10)))


def late_indicator(df: DataFrame) -> DataFrame:
    late = "days_entry_payment > days_instalment"
    return df.selectExpr("prev_id", APP, f"{X.indicator(late)} AS late", f"{X.as_number(late)} AS late_known")


# Verification


def _each_role(step: Callable[[str], object]) -> dict:
    """A step for every table, as concurrent jobs: the many short stages of the fits share the cluster."""
    with ThreadPoolExecutor(max_workers=len(ROLES)) as pool:
        return dict(zip(ROLES, pool.map(step, ROLES)))


def _stored_cleaned(spark: SparkSession, sf: str) -> tuple[dict, list[str], dict]:
    """The cleaned views, written and read back under the table names they stand for."""
    raw = stored_views(spark, sf, VIEWS)
    paths = {table: staging_path(spark, table) for table in ROLES}

    def write(table: str) -> tuple[int, int]:
        name, columns = ROLES[table]
        write_parquet(cleaning.clean(raw[name], SPECS[name]), paths[table])
        return raw[name].count(), columns

    shapes = _each_role(write)
    paths["absent"] = staging_path(spark, "absent")  # never written
    tables, missing = load_existing(spark, paths)
    return tables, missing, shapes


def verify_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    tables, missing, shapes = _stored_cleaned(spark, sf)
    rows = prepare.check_tables(tables, DROPPED, shapes, ACCEPTABLE, DAYS, "days_employed")
    return checks.combine(checks.loaded(spark, [*shapes, *missing], missing), *rows)


def verify_on_write(spark: SparkSession, sf: str) -> DataFrame:
    """The same checks, taken by the tasks that write the cleaned tables."""
    spark = spark.newSession()
    raw = stored_views(spark, sf, VIEWS)
    paths = {table: staging_path(spark, table) for table in ROLES}
    shapes = {table: (raw[name].count(), columns) for table, (name, columns) in ROLES.items()}
    tables = _each_role(lambda table: cleaning.clean(raw[ROLES[table][0]], SPECS[ROLES[table][0]]))
    return prepare.write_checked(tables, paths, DROPPED, shapes, ACCEPTABLE, DAYS, "days_employed")


def verify_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return checks.verdict(verify_cleaned(spark, sf))


# Features and models


def ratio_features(df: DataFrame) -> DataFrame:
    return M.with_ratios(df, "amt_credit", "amt_annuity", "amt_income").select(
        APP, "Credit_to_Income", "Annuity_to_Income"
    )


def scaled_columns(df: DataFrame) -> list[str]:
    return [*numeric_columns(df.schema, "int_double", ("target", APP)), "Credit_to_Income", "Annuity_to_Income"]


def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    app = cleaned("v_app")(spark, sf)
    vectors = M.application_features(
        app, "target", APP, credit="amt_credit", annuity="amt_annuity", income="amt_income"
    )
    path = staging_path(spark, "vectors")
    write_features(vectors, path, (APP, "target", "scaled_features"))
    values = vector_to_array("scaled_features")
    named = [
        (F.round(values[i], 6) + F.lit(0.0)).alias(f"z_{c}") for i, c in enumerate(scaled_columns(app))
    ]
    return spark.read.parquet(path).select(APP, "target", *named)


def impute_mean(df: DataFrame) -> DataFrame:
    names = ["amt_income", "amt_annuity", "car_age", "house_age"]
    filled = M.imputed(df, names)
    return filled.select(
        APP,
        *[F.round(f"{c}_imp", 4).alias(f"{c}_imp") for c in names[:2]],
        *[f"{c}_imp" for c in names[2:]],
    )


def split_80_20(df: DataFrame) -> DataFrame:
    train, test = M.split_by_key(df.select(APP), APP)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def auc_of_score(df: DataFrame) -> DataFrame:
    scored = df.select(F.col("target").cast("double").alias("target"), F.col("amt_credit").alias("score"))
    value = M.auc(scored, "target", "score", bins=0)
    return df.sparkSession.createDataFrame([(round(value, 8),)], "auc DOUBLE")


def fitted_well(model, data: DataFrame) -> bool:
    """Logistic regression: at the optimum. Forest: trees and depth as asked for."""
    last = model.stages[-1]
    if hasattr(last, "coefficients"):
        return M.gradient_size(model, data, "target") < 1e-3
    return last.getNumTrees == 100 and max(t.depth for t in last.trees) <= 6


def split_random(df: DataFrame) -> DataFrame:
    """The seeded random split: no row lost or doubled, and about four fifths for training."""
    first, second = (part.select(APP) for part in M.split_random(stage(df.select(APP), "split")))
    n, trained = df.count(), first.count()
    whole = first.union(second)
    near = abs(trained - 0.8 * n) <= 5 * (0.16 * n) ** 0.5
    return whole.agg(F.count("*").alias("rows"), F.countDistinct(APP).alias("keys")).withColumn("share_near", F.lit(near))


def counted_write(df: DataFrame) -> DataFrame:
    path = staging_path(df.sparkSession, "counted")
    written = write_counted(df, path)
    return df.sparkSession.read.parquet(path).agg(F.count("*").alias("read"), F.lit(written).alias("written"))


def preview(df: DataFrame) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy("prev_id").limit(10)


def train(model: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        table = stage(final_features("auto")(spark, sf), "features")
        chosen, place = {model: M.classifiers("target")[model]}, staging_path(spark, "models")
        scores, fitted = M.train_and_evaluate(table, "target", APP, chosen, save_to=place)
        train_part, test_part = M.split_by_key(table, APP)
        again = load_model(f"{place}/model_{model}")
        area = scores.first()["auc"]
        return scores.select(
            "model",
            F.lit(train_part.count()).alias("train_rows"),
            F.lit(test_part.count()).alias("test_rows"),
            F.lit(0.0 <= area <= 1.0).alias("auc_in_range"),
            F.lit(M.probability_gap(fitted[model].transform(test_part), again.transform(test_part), APP) == 0.0).alias("reload_equal"),
            F.lit(fitted_well(fitted[model], train_part)).alias("fitted_well"),
        )

    return run


# Round trips


def roundtrip_csv(df: DataFrame) -> DataFrame:
    path = staging_path(df.sparkSession, "csv")
    write_csv(df, path, "XNA")
    return read_csv(df.sparkSession, path, df.schema, "XNA")


def roundtrip_csv_inferred(df: DataFrame) -> DataFrame:
    """Without a schema: the token column is inferred numeric because the token is NULL."""
    path = staging_path(df.sparkSession, "csv")
    write_csv(df, path, "XNA")
    back = read_csv(df.sparkSession, path, None, "XNA")
    return back.select(F.col(APP).cast("long").alias(APP), "amt_income", "car_age", "segment")


def roundtrip_csv_supplied(df: DataFrame) -> DataFrame:
    """A table of the registry, read with a schema from outside."""
    root = staging_path(df.sparkSession, "raw")
    write_csv(df, f"{root}/{TABLES['bureau'].stem}.csv", "XNA")
    ddl = ", ".join(f"{c} {t}" for c, t in df.dtypes)
    return read_raw(df.sparkSession, root, ["bureau"], schemas={"bureau": ddl})["bureau"]


def csv_rejected(df: DataFrame) -> DataFrame:
    """Cells of a CSV file that the declared schema cannot read: some amounts and codes are words."""
    path = staging_path(df.sparkSession, "csv-broken")
    word = {"amt_credit_sum": "bureau_id % 50 = 0", "days_credit": "bureau_id % 35 = 0"}
    text = [F.expr(f"CASE WHEN {word[c]} THEN 'about ' || bureau_id ELSE CAST({c} AS STRING) END" if c in word else c).alias(c) for c in df.columns]
    write_csv(df.select(*text), path, "XNA")
    return checks.cells_readable(rejected_cells(df.sparkSession, path, df.schema, "XNA"), "v_bureau")


def roundtrip_parquet(df: DataFrame) -> DataFrame:
    path = staging_path(df.sparkSession, "parquet")
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


QUERIES: dict[str, Query] = {
    "agg_bureau": on_view("v_bureau", BUREAU),
    "agg_balance": on_view("v_balance", BALANCE),
    "agg_previous": on_view("v_prev", PREVIOUS),
    "agg_installments": on_view("v_inst", INSTALLMENTS),
    "agg_card": on_view("v_card", CARD),
    "agg_pos": on_view("v_pos", POS),
    "left_join_checked": one_left_join,
    "bureau_with_balance": bureau_with_balance,
    "enrich_side_table": enrich_side_table,
    "final_features_auto": final_features("auto"),
    "final_features_broadcast": final_features("broadcast"),
    "final_features_shuffle": final_features("shuffle"),
    "final_features_with_balance": final_features_with_balance,
    "join_skewed": join_skewed,
    "join_skewed_repeated": join_skewed_repeated,
    "final_features_bucketed": final_features_bucketed,
    "join_variants": join_variants,
    "default_rollups": default_rollups,
    "default_medians_sketch": default_medians_sketch,
    "default_medians": default_medians,
    "split_random": on_view("v_app", split_random),
    "counted_write": on_view("v_card", counted_write),
    "preview": on_view("v_prev", preview),
    "roundtrip_csv_supplied": on_view("v_bureau", roundtrip_csv_supplied),
    "status_distribution": on_view("v_prev", lambda df: profile.value_counts(df, "contract_status")),
    "null_profile": on_view("v_app", null_profile),
    "missing_report": over_views(VIEWS, profile.missing_report),
    "sentinel_profile": on_view("v_prev", sentinel_profile),
    "sentinel_one_column": on_view("v_app", sentinel_one_column),
    "sign_profile": sign_profile,
    "amount_range": over_views(PRICED, amount_range),
    "quartiles": on_view("v_bureau", quartiles),
    "mode_profile": on_view("v_prev", mode_profile),
    "mode_profile_candidates": on_view("v_prev", mode_profile_candidates),
    "fix_sentinel": on_view("v_prev", fix_sentinel),
    "fix_positive_days": on_view("v_bureau", fix_positive_days),
    "fix_negative_amount": on_view("v_inst", fix_negative_amount),
    "filter_birth": on_view("v_app", filter_birth),
    "late_indicator": on_view("v_inst", late_indicator),
    "drop_sparse_50": on_view("v_app", lambda df: cleaning.drop_sparse(df, 0.5, True)),
    "drop_sparse_60": on_view("v_app", lambda df: cleaning.drop_sparse(df, 0.6, False)),
    "fill_unknown": on_view("v_app", cleaning.fill_constant),
    "fill_median": on_view("v_bureau", lambda df: cleaning.fill_median(df, **EXACT)),
    "fill_mode": on_view("v_app", cleaning.fill_mode),
    "fill_mode_candidates": on_view("v_app", lambda df: cleaning.fill_mode(df, by_candidates=True)),
    "clip_iqr": on_view("v_app", lambda df: cleaning.fence(df, ("amt_income", "amt_credit"), **EXACT)),
    "reset_range": on_view("v_app", reset_range),
    "null_range_median": on_view("v_app", lambda df: cleaning.refill_outside(df, {"vehicle_age": (0, 100)}, **EXACT)),
    "clean_module": on_view("v_app", lambda df: cleaning.clean(df, presets.basic_application("days_birth", "days_employed", **EXACT))),
    "clean_app": cleaned("v_app"),
    "clean_bureau": cleaned("v_bureau"),
    "clean_balance": cleaned("v_balance"),
    "clean_previous": cleaned("v_prev"),
    "clean_pos": cleaned("v_pos"),
    "clean_installments": cleaned("v_inst"),
    "clean_card": cleaned("v_card"),
    "table_summary": table_summary,
    "null_cells": null_cells,
    "top_null_columns": on_view("v_app", profile.top_null_columns),
    "top_null_columns_all": over_views(VIEWS, profile.top_null_columns),
    "null_reduction": null_reduction,
    "verify_cleaned": verify_cleaned,
    "verify_on_write": verify_on_write,
    "verify_verdict": verify_verdict,
    "ratio_features": on_view("v_app", ratio_features),
    "scaled_features": scaled_features,
    "impute_mean": on_view("v_app", impute_mean),
    "split_80_20": on_view("v_app", split_80_20),
    "auc_of_score": on_view("v_app", auc_of_score),
    "train_lr": train("LogisticRegression"),
    "train_rf": train("RandomForest"),
    "roundtrip_csv": on_view("v_app", roundtrip_csv),
    "roundtrip_csv_inferred": on_view("v_app", roundtrip_csv_inferred),
    "csv_rejected": on_view("v_bureau", csv_rejected),
    "roundtrip_parquet": on_view("v_card", roundtrip_parquet),
}
