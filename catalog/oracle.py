"""ANSI SQL with the same result as each registered query.

Written from the meaning of the operator: plain aggregates, exact quantiles and
grouped modes over the test tables.
"""

from __future__ import annotations

from catalog.views import ansi, column_names

RAW = ("v_app", "v_app_test", "v_bureau", "v_balance", "v_prev", "v_inst", "v_card", "v_pos")
DAYS_APP = ("days_birth", "days_employed", "days_registration")


def query(body: str, *views: str, **ctes: str) -> str:
    parts = [f"{v} AS ({ansi(v)})" for v in views] + [f"{n} AS ({s})" for n, s in ctes.items()]
    return f"WITH {', '.join(parts)} {body}"


def union(selects: list[str]) -> str:
    return " UNION ALL ".join(selects)


def exact_sum(c: str, scale: int) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def exact_mean(c: str, scale: int) -> str:
    return f"{exact_sum(c, scale)} / nullif(count({c}), 0)"


def flipped(c: str) -> str:
    return f"CASE WHEN {c} > 0 THEN -{c} ELSE {c} END"


def mode_of(c: str, table: str) -> str:
    """The fill value: no value if NULL or the empty text is most frequent."""
    top = f"SELECT {c} FROM {table} GROUP BY {c} ORDER BY count(*) DESC, {c} ASC NULLS LAST LIMIT 1"
    return f"nullif(({top}), '')"


def median_of(c: str, table: str) -> str:
    return f"(SELECT quantile_disc({c}, 0.5) FROM {table})"


def rewritten(view: str, changes: dict[str, str], dropped: tuple[str, ...] = (), table: str | None = None) -> str:
    """All columns of ``view`` but the dropped ones, some of them as new expressions."""
    kept = [c for c in column_names(view) if c not in dropped]
    return "SELECT " + ", ".join(f"{changes[c]} AS {c}" if c in changes else c for c in kept) + f" FROM {table or view}"


def filled(c: str, table: str) -> str:
    return f"coalesce({c}, {median_of(c, table)})"


def fenced(c: str, table: str) -> str:
    q1, q3 = (f"(SELECT quantile_disc({c}, {p}) FROM {table})" for p in (0.25, 0.75))
    low, high = f"({q1} - 3.0 * ({q3} - {q1}))", f"({q3} + 3.0 * ({q3} - {q1}))"
    return f"CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} THEN {high} ELSE {c} END"


# Roll-ups

AGG = {
    "v_bureau": f"""SELECT app_id, count(bureau_id) AS bureau_loan_count,
        {exact_sum('amt_credit_sum', 2)} AS bureau_total_credit,
        {exact_sum('amt_credit_sum_debt', 2)} AS bureau_total_debt,
        avg(days_credit) AS bureau_avg_days_credit,
        CAST(sum(CASE WHEN credit_active = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS bureau_active_loans
        FROM v_bureau GROUP BY app_id""",
    "v_prev": f"""SELECT app_id, count(prev_id) AS prev_app_count,
        {exact_mean('amt_application', 2)} AS prev_avg_application,
        {exact_mean('amt_credit', 2)} AS prev_avg_credit,
        CAST(sum(CASE WHEN contract_status = 'Approved' THEN 1 ELSE 0 END) AS BIGINT) AS prev_approved_count,
        CAST(sum(CASE WHEN contract_status = 'Refused' THEN 1 ELSE 0 END) AS BIGINT) AS prev_refused_count
        FROM v_prev GROUP BY app_id""",
    "v_inst": f"""SELECT app_id, count(prev_id) AS inst_count,
        {exact_mean('payment_diff', 4)} AS inst_avg_payment_diff,
        avg(days_late) AS inst_avg_days_late,
        CAST(sum(CASE WHEN days_late > 0 THEN 1 ELSE 0 END) AS BIGINT) AS inst_late_count
        FROM (SELECT *, amt_instalment - amt_payment AS payment_diff,
                     days_entry_payment - days_instalment AS days_late FROM v_inst)
        GROUP BY app_id""",
    "v_card": f"""SELECT app_id, {exact_mean('amt_balance', 2)} AS cc_avg_balance,
        avg(amt_credit_limit) AS cc_avg_credit_limit, avg(cnt_drawings) AS cc_avg_drawings
        FROM v_card GROUP BY app_id""",
    "v_pos": """SELECT app_id, count(prev_id) AS pos_count, avg(cnt_instalment) AS pos_avg_instalment,
        CAST(sum(CASE WHEN contract_status = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS pos_active_count
        FROM v_pos GROUP BY app_id""",
}
BALANCE = """SELECT bureau_id, count(months_balance) AS bb_months_count,
    avg(TRY_CAST(status AS DOUBLE)) AS bb_avg_status FROM v_balance GROUP BY bureau_id"""
FINAL = query(
    "SELECT v_app.*, " + ", ".join(f"s{i}.* EXCLUDE (app_id)" for i in range(len(AGG))) + " FROM v_app "
    + " ".join(f"LEFT JOIN ({sql}) s{i} ON v_app.app_id = s{i}.app_id" for i, sql in enumerate(AGG.values())),
    "v_app",
    *AGG,
)

# Cleaned views

REPAIRED_APP = rewritten(
    "v_app",
    {
        "days_birth": flipped("days_birth"),
        "days_employed": flipped("nullif(days_employed, 365243)"),
        "days_registration": flipped("days_registration"),
    },
    ("car_age",),
)
FILLED_APP = rewritten(
    "v_app",
    {c: filled(c, "repaired") for c in ("days_employed", "amt_income", "amt_annuity", "house_age")}
    | {c: f"coalesce({c}, {mode_of(c, 'repaired')})" for c in ("segment", "occupation")}
    | {"vehicle_age": "CASE WHEN vehicle_age < 0 OR vehicle_age > 100 THEN NULL ELSE vehicle_age END"},
    ("car_age",),
    "repaired",
)
CLEAN_APP = rewritten(
    "v_app",
    {c: fenced(c, "filled") for c in ("amt_income", "amt_credit", "amt_annuity")}
    | {
        "vehicle_age": filled("vehicle_age", "filled"),
        "cnt_children": "CASE WHEN cnt_children < 0 OR cnt_children > 10 THEN 0 ELSE cnt_children END",
    },
    ("car_age",),
    "filled",
)
REPAIRED_BUREAU = rewritten("v_bureau", {"days_credit": flipped("days_credit")}, ("amt_overdue",))
CLEAN_BUREAU = rewritten(
    "v_bureau",
    {c: filled(c, "repaired_bureau") for c in ("amt_credit_sum", "amt_credit_sum_debt")},
    ("amt_overdue",),
    "repaired_bureau",
)
REPAIRED_PREV = rewritten(
    "v_prev", {"days_first_due": flipped("nullif(days_first_due, 365243)")}, ("days_first_drawing",)
)
CLEAN_PREV = rewritten(
    "v_prev",
    {c: filled(c, "repaired_prev") for c in ("amt_credit", "days_first_due")}
    | {"suite_type": f"coalesce(suite_type, {mode_of('suite_type', 'repaired_prev')})"},
    ("days_first_drawing",),
    "repaired_prev",
)
REPAIRED_INST = rewritten(
    "v_inst",
    {c: f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END" for c in ("amt_payment", "amt_instalment")}
    | {c: flipped(c) for c in ("days_instalment", "days_entry_payment")},
)
CLEAN_INST = rewritten(
    "v_inst",
    {c: filled(c, "repaired_inst") for c in ("amt_payment", "days_entry_payment")},
    (),
    "repaired_inst",
)
# CTEs and the views they need, per cleaned view.
CLEANED = {
    "v_app_test": {
        f"{name}_test": sql.replace("target, ", "").replace("FROM v_app", "FROM v_app_test")
        .replace("FROM repaired", "FROM repaired_test").replace("FROM filled", "FROM filled_test")
        for name, sql in (("repaired", REPAIRED_APP), ("filled", FILLED_APP), ("clean_app", CLEAN_APP))
    },
    "v_balance": {
        "clean_balance": rewritten("v_balance", {"status": f"coalesce(status, {mode_of('status', 'v_balance')})"})
    },
    "v_pos": {
        "clean_pos": rewritten("v_pos", {
            "cnt_instalment": filled("cnt_instalment", "v_pos"),
            "contract_status": f"coalesce(contract_status, {mode_of('contract_status', 'v_pos')})",
        }),
    },
    "v_card": {"clean_card": rewritten("v_card", {c: filled(c, "v_card") for c in ("amt_balance", "cnt_drawings")})},
    "v_app": {"repaired": REPAIRED_APP, "filled": FILLED_APP, "clean_app": CLEAN_APP},
    "v_bureau": {"repaired_bureau": REPAIRED_BUREAU, "clean_bureau": CLEAN_BUREAU},
    "v_prev": {"repaired_prev": REPAIRED_PREV, "clean_prev": CLEAN_PREV},
    "v_inst": {"repaired_inst": REPAIRED_INST, "clean_inst": CLEAN_INST},
}


def cleaned(view: str) -> str:
    return query(f"SELECT * FROM {list(CLEANED[view])[-1]}", view, **CLEANED[view])


SCALED = [
    "days_birth", "days_employed", "days_registration", "amt_income", "amt_credit", "amt_annuity",
    "house_age", "vehicle_age", "cnt_children", "Credit_to_Income", "Annuity_to_Income",
]
RATIOS = """amt_credit / nullif(amt_income, 0) AS Credit_to_Income,
    amt_annuity / nullif(amt_income, 0) AS Annuity_to_Income"""

KEPT_BASIC = ("occupation", "car_age", "house_age")  # columns dropped at 50 %
CLEAN_BASIC = query(
    rewritten(
        "v_app",
        {c: filled(c, "rows_kept") for c in ("days_employed", "amt_income", "amt_annuity")}
        | {"segment": "coalesce(segment, 'Unknown')"},
        KEPT_BASIC,
        "rows_kept",
    ),
    "v_app",
    rows_kept=rewritten("v_app", {"days_employed": "nullif(days_employed, 365243)"}, KEPT_BASIC)
    + " WHERE days_birth < 0",
)


# Profiles


def nulls(table: str, columns: list[str]) -> str:
    return union(
        [f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(*) - count({c}) AS nulls FROM {table}" for c in columns]
    )


def null_total(table: str, columns: list[str]) -> str:
    return "CAST(" + " + ".join(f"(count(*) - count({c}))" for c in columns) + f" AS BIGINT) AS nulls FROM {table}"


def hits(table: str, columns: tuple[str, ...], test: str, extra: str = "") -> str:
    return union(
        [
            f"SELECT '{c}' AS \"column\"{extra}, CAST(count(*) FILTER (WHERE {c} {test}) AS BIGINT) AS hits,"
            f" count(*) AS \"rows\" FROM {table}"
            for c in columns
        ]
    )


SUMMARY = union(
    [
        f"SELECT '{v}' AS \"table\", count(*) AS \"rows\", {len(column_names(v))} AS cols, {null_total(v, column_names(v))}"
        for v in RAW
    ]
)
APP_TYPES = {"amt_income": "double", "amt_annuity": "double", "segment": "string", "occupation": "string",
             "car_age": "int", "house_age": "int"}
# Columns with NULLs in each view.
NULL_TYPES = {
    "v_app": APP_TYPES,
    "v_app_test": APP_TYPES,
    "v_bureau": {"amt_credit_sum": "double", "amt_credit_sum_debt": "double", "amt_overdue": "double"},
    "v_balance": {"status": "string"},
    "v_prev": {"amt_credit": "double", "suite_type": "string"},
    "v_inst": {"amt_payment": "double", "days_entry_payment": "int"},
    "v_card": {"amt_balance": "double", "cnt_drawings": "int"},
    "v_pos": {"cnt_instalment": "int", "contract_status": "string"},
}
DEBTS = ("amt_credit_sum", "amt_credit_sum_debt", "amt_overdue")
REDUCED = {v: list(ctes)[-1] for v, ctes in CLEANED.items()}
LEFT_OVER = {v: column_names(v) for v in RAW} | {
    "v_app": [c for c in column_names("v_app") if c != "car_age"],
    "v_app_test": [c for c in column_names("v_app_test") if c != "car_age"],
    "v_bureau": [c for c in column_names("v_bureau") if c != "amt_overdue"],
    "v_prev": [c for c in column_names("v_prev") if c != "days_first_drawing"],
}
_ALL_CLEANED = {name: sql for ctes in CLEANED.values() for name, sql in ctes.items()}


# Verification


def check(name: str, table: str, subject: str, status: str, detail: str, source: str = "") -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{table}' AS \"table\", {subject} AS subject, {status} AS status,"
        f" CAST({detail} AS BIGINT) AS detail {source}"
    )


def _checks() -> str:
    tables = {"app_train": "v_app", "app_test": "v_app_test", "bureau": "v_bureau", "bureau_bal": "v_balance", "prev_app": "v_prev",
              "pos_cash": "v_pos", "credit_card": "v_card", "installments": "v_inst"}
    dropped = {"app_train": "car_age", "app_test": "car_age", "bureau": "amt_overdue", "prev_app": "days_first_drawing"}
    days = {"app_train": DAYS_APP, "app_test": DAYS_APP, "bureau": ("days_credit",), "prev_app": ("days_first_due",),
            "installments": ("days_instalment", "days_entry_payment")}
    marked = {"app_train": "days_employed", "app_test": "days_employed", "prev_app": "days_first_due"}
    widths = {"app_train": 13, "app_test": 12, "bureau": 6, "bureau_bal": 3, "prev_app": 7, "pos_cash": 4, "credit_card": 5, "installments": 6}
    out = [check("loaded", "absent", "'*'", "'FAIL'", "0")]
    for table, raw in tables.items():
        columns, clean = LEFT_OVER[raw], REDUCED[raw]
        out.append(check("loaded", table, "'*'", "'PASS'", "1"))
        for c in days.get(table, ()):
            bad = f"(SELECT count(*) FROM {clean} WHERE {c} > 0)"
            worst = "'FAIL'" if c == "days_employed" else "'WARN'"
            out.append(check("days_not_positive", table, f"'{c}'", f"CASE WHEN {bad} = 0 THEN 'PASS' ELSE {worst} END", bad))
        if table in marked:
            c = marked[table]
            bad = f"(SELECT count(*) FROM {clean} WHERE {c} = 365243)"
            out.append(check("sentinel_gone", table, f"'{c}'", f"CASE WHEN {bad} = 0 THEN 'PASS' ELSE 'FAIL' END", bad))
        if table in ("app_train", "app_test"):
            gaps = f"(SELECT count(*) FROM {clean} WHERE days_employed IS NULL)"
            out.append(check("remaining_nulls", table, "'days_employed'", "'PASS'", gaps))
        if table in dropped:
            out.append(check("dropped", table, f"'{dropped[table]}'", "'PASS'", "0"))
        size = f"(SELECT count(*) FROM {raw})"
        out.append(check("shape", table, f"{size} || ' x {widths[table]}'", "'PASS'", f"(SELECT count(*) FROM {clean})"))
        gaps = f"(SELECT {null_total(clean, columns)})"
        accepted = "acceptable" if table in ("app_train", "app_test", "prev_app") else "review"
        state = f"CASE WHEN {gaps} = 0 THEN 'clean' ELSE '{accepted}' END"
        status = "'PASS'" if accepted == "acceptable" else f"CASE WHEN {gaps} = 0 THEN 'PASS' ELSE 'FAIL' END"
        out.append(check("nulls", table, state, status, gaps))
    return union(out)


CHECKED_VIEWS = RAW
SKEWED = "SELECT CASE WHEN prev_id % 3 = 0 THEN 1 WHEN prev_id % 7 = 0 THEN NULL ELSE app_id END AS app_id, prev_id, cnt_instalment FROM v_pos"
BALANCE_SECOND = """SELECT app_id, count(DISTINCT v_bureau.bureau_id) AS bb_loans,
        count(DISTINCT v_balance.bureau_id) AS bb_loans_with_history,
        nullif(count(months_balance), 0) AS bb_months_total, avg(TRY_CAST(status AS DOUBLE)) AS bb_avg_status
        FROM v_bureau LEFT JOIN v_balance ON v_bureau.bureau_id = v_balance.bureau_id GROUP BY app_id"""


MODES_FILLED = query(rewritten("v_app", {c: f"coalesce({c}, {mode_of(c, 'v_app')})" for c in ("segment", "occupation")}), "v_app")
NEAR = union([f"SELECT '{c}' AS \"column\", CAST({e} AS DOUBLE) AS rel_error, true AS near" for c in DEBTS for e in (0.01, 0.001)])


def trained(name: str) -> str:
    return query(
        f"SELECT '{name}' AS model, CAST(count(*) FILTER (WHERE part = 'train') AS INT) AS train_rows,"
        " CAST(count(*) FILTER (WHERE part = 'test') AS INT) AS test_rows, true AS auc_in_range, true AS reload_equal,"
        " true AS fitted_well FROM parts",
        "v_app",
        parts="SELECT CASE WHEN ('0x' || substr(md5(CAST(app_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80"
        " THEN 'train' ELSE 'test' END AS part FROM v_app",
    )



ORACLE: dict[str, str] = {
    "agg_bureau": query(AGG["v_bureau"], "v_bureau"),
    "agg_balance": query(BALANCE, "v_balance"),
    "agg_previous": query(AGG["v_prev"], "v_prev"),
    "agg_installments": query(AGG["v_inst"], "v_inst"),
    "agg_card": query(AGG["v_card"], "v_card"),
    "agg_pos": query(AGG["v_pos"], "v_pos"),
    "left_join_checked": query(
        f"SELECT v_app.*, s.* EXCLUDE (app_id) FROM v_app LEFT JOIN ({AGG['v_card']}) s ON v_app.app_id = s.app_id",
        "v_app", "v_card",
    ),
    "bureau_with_balance": query(
        f"SELECT v_bureau.*, bb_months_count, bb_avg_status FROM v_bureau LEFT JOIN ({BALANCE}) b"
        " ON v_bureau.bureau_id = b.bureau_id",
        "v_bureau", "v_balance",
    ),
    "enrich_side_table": query(BALANCE_SECOND, "v_bureau", "v_balance"),
    "final_features_with_balance": query(
        "SELECT v_app.*, " + ", ".join(f"s{i}.* EXCLUDE (app_id)" for i in range(len(AGG))) + ", b.* EXCLUDE (app_id) FROM v_app "
        + " ".join(f"LEFT JOIN ({sql}) s{i} ON v_app.app_id = s{i}.app_id" for i, sql in enumerate(AGG.values()))
        + f" LEFT JOIN ({BALANCE_SECOND}) b ON v_app.app_id = b.app_id",
        "v_app", "v_balance", *AGG,
    ),
    "join_skewed": query(
        f"SELECT base.*, s.* EXCLUDE (app_id), t.* EXCLUDE (app_id) FROM base LEFT JOIN ({AGG['v_bureau']}) s ON base.app_id = s.app_id"
        f" LEFT JOIN ({AGG['v_card']}) t ON base.app_id = t.app_id",
        "v_pos", "v_bureau", "v_card", base=SKEWED,
    ),
    "join_skewed_repeated": query(
        "SELECT base.*, bureau_id, credit_active FROM base LEFT JOIN v_bureau ON base.app_id = v_bureau.app_id", "v_pos", "v_bureau", base=SKEWED
    ),
    "join_variants": query(
        'SELECT variant, (SELECT count(*) FROM v_app) AS "rows", plan_has_broadcast FROM v', "v_app",
        v="SELECT 'shuffle' AS variant, false AS plan_has_broadcast UNION ALL SELECT 'broadcast', true",
    ),
    "default_rollups": query(
        union([f"SELECT DISTINCT '{v}' AS \"view\", app_id, true AS close, true AS same FROM {v}" for v in AGG if v != "v_pos"]),
        *[v for v in AGG if v != "v_pos"],
    ),
    "default_medians": NEAR,
    "default_medians_sketch": NEAR,
    "split_random": query("SELECT count(*) AS \"rows\", count(DISTINCT app_id) AS keys, true AS share_near FROM v_app", "v_app"),
    "counted_write": query("SELECT count(*) AS read, CAST(count(*) AS INT) AS written FROM v_card", "v_card"),
    "preview": query("SELECT * FROM v_prev ORDER BY prev_id LIMIT 10", "v_prev"),
    "roundtrip_csv_supplied": query("SELECT * FROM v_bureau", "v_bureau"),
    "train_lr": trained("LogisticRegression"),
    "train_rf": trained("RandomForest"),
    "final_features_bucketed": FINAL,
    "final_features_auto": FINAL,
    "final_features_broadcast": FINAL,
    "final_features_shuffle": FINAL,
    "status_distribution": query("SELECT contract_status, count(*) AS n FROM v_prev GROUP BY contract_status", "v_prev"),
    "null_profile": query(nulls("v_app", column_names("v_app")), "v_app"),
    "missing_report": query(
        """SELECT "table", "column", type, nulls, pct, CASE WHEN pct > 60 THEN 'DROP column (>60%)'
        WHEN type = 'string' THEN 'Fill MODE' ELSE 'Fill MEDIAN' END AS strategy
        FROM (SELECT *, round(nulls / "rows" * 100, 2) AS pct FROM counts)
        WHERE nulls > 0""",
        *RAW,
        counts=union([
            f"SELECT '{v}' AS \"table\", '{t}' AS type, c.* FROM ({nulls(v, [c])}) c" for v, types in NULL_TYPES.items() for c, t in types.items()
        ]),
    ),
    "sentinel_profile": query(
        'SELECT "column", hits, "rows", hits * 100.0::DOUBLE / "rows" AS pct FROM h WHERE hits > 0',
        "v_prev", h=hits("v_prev", ("days_first_due", "days_first_drawing"), "= 365243"),
    ),
    "sentinel_one_column": query(
        'SELECT "column", hits, "rows", hits * 100.0::DOUBLE / "rows" AS pct FROM h',
        "v_app", h=hits("v_app", ("days_employed",), "= 365243"),
    ),
    "sign_profile": query(
        'SELECT "table", "column", sign, hits, "rows" FROM h WHERE hits > 0', *RAW,
        h=union([
            hits(v, days, "> 0", f", 'positive' AS sign, '{v}' AS \"table\"")
            for v, days in (("v_app", DAYS_APP), ("v_app_test", DAYS_APP), ("v_bureau", ("days_credit",)),
                            ("v_prev", ("days_first_due", "days_first_drawing")), ("v_inst", ("days_instalment", "days_entry_payment")))
        ] + [
            hits(v, amounts, "< 0", f", 'negative' AS sign, '{v}' AS \"table\"")
            for v, amounts in (("v_bureau", DEBTS), ("v_inst", ("amt_instalment", "amt_payment")))
        ]),
    ),
    "amount_range": query(
        union([
            f"SELECT '{v}' AS \"table\", '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,"
            f" {exact_mean(c, 4)} AS mean FROM {v}"
            for v in ("v_app", "v_app_test", "v_bureau", "v_prev", "v_inst", "v_card") for c in column_names(v) if c.startswith("amt_")
        ]),
        *RAW,
    ),
    "quartiles": query(
        union([
            f"SELECT '{c}' AS \"column\", quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.5) AS median,"
            f" quantile_disc({c}, 0.75) AS q3 FROM v_bureau"
            for c in DEBTS
        ]),
        "v_bureau",
    ),
    "mode_profile": query(
        union([
            f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM v_prev GROUP BY {c}"
            f" ORDER BY n DESC, value ASC NULLS LAST LIMIT 1)"
            for c in ("contract_status", "suite_type")
        ]),
        "v_prev",
    ),
    "mode_profile_candidates": query(
        union([
            f"SELECT * FROM (SELECT '{c}' AS \"column\", {v} AS value, count(*) AS n FROM v_prev GROUP BY {v}"
            f" ORDER BY n DESC, value ASC NULLS LAST LIMIT 1)"
            for c, v in (("contract_status", "contract_status"), ("suite_type", "suite_type"), ("distinct_code", "'p' || CAST(prev_id AS VARCHAR)"))
        ]),
        "v_prev",
    ),
    "fix_sentinel": query(
        rewritten("v_prev", {c: f"nullif({c}, 365243)" for c in ("days_first_due", "days_first_drawing")}), "v_prev"
    ),
    "fix_positive_days": query(rewritten("v_bureau", {"days_credit": flipped("days_credit")}), "v_bureau"),
    "fix_negative_amount": query(
        rewritten("v_inst", {c: f"CASE WHEN {c} >= 0 THEN {c} END" for c in ("amt_payment", "amt_instalment")}), "v_inst"
    ),
    "filter_birth": query("SELECT * FROM v_app WHERE days_birth < 0", "v_app"),
    "late_indicator": query(
        """SELECT prev_id, app_id, CASE WHEN days_entry_payment > days_instalment THEN 1 ELSE 0 END AS late,
        CAST(days_entry_payment > days_instalment AS INT) AS late_known FROM v_inst""",
        "v_inst",
    ),
    "drop_sparse_50": query("SELECT * EXCLUDE (occupation, car_age, house_age) FROM v_app", "v_app"),
    "drop_sparse_60": query("SELECT * EXCLUDE (car_age) FROM v_app", "v_app"),
    "fill_unknown": query(
        rewritten("v_app", {c: f"coalesce({c}, 'Unknown')" for c in ("segment", "occupation")}), "v_app"
    ),
    "fill_median": query(rewritten("v_bureau", {c: filled(c, "v_bureau") for c in DEBTS}), "v_bureau"),
    "fill_mode": MODES_FILLED,
    "fill_mode_candidates": MODES_FILLED,
    "clip_iqr": query(rewritten("v_app", {c: fenced(c, "v_app") for c in ("amt_income", "amt_credit")}), "v_app"),
    "reset_range": query(
        rewritten("v_app", {"cnt_children": "CASE WHEN cnt_children BETWEEN 0 AND 10 THEN cnt_children ELSE 0 END"}), "v_app"
    ),
    "null_range_median": query(
        rewritten("v_app", {"vehicle_age": filled("vehicle_age", "ranged")}, (), "ranged"), "v_app",
        ranged=rewritten("v_app", {"vehicle_age": "CASE WHEN vehicle_age BETWEEN 0 AND 100 THEN vehicle_age END"}),
    ),
    "clean_module": CLEAN_BASIC,
    "clean_app": cleaned("v_app"),
    "clean_bureau": cleaned("v_bureau"),
    "clean_balance": cleaned("v_balance"),
    "clean_previous": cleaned("v_prev"),
    "clean_pos": cleaned("v_pos"),
    "clean_installments": cleaned("v_inst"),
    "clean_card": cleaned("v_card"),
    "table_summary": query(SUMMARY, *RAW),
    "null_cells": query(
        """SELECT *, nulls / ("rows" * cols) * 100 AS pct, CASE WHEN nulls = 0 THEN 'clean'
        WHEN "table" IN ('v_app', 'v_app_test', 'v_prev') THEN 'acceptable' ELSE 'review' END AS status FROM summary""",
        *RAW, summary=SUMMARY,
    ),
    "top_null_columns": query(
        'SELECT "column", nulls FROM counts WHERE nulls > 0 ORDER BY nulls DESC, "column" LIMIT 5',
        "v_app", counts=nulls("v_app", column_names("v_app")),
    ),
    "top_null_columns_all": query(
        union([
            f"SELECT * FROM (SELECT '{v}' AS \"table\", \"column\", nulls FROM ({nulls(v, column_names(v))}) WHERE nulls > 0"
            ' ORDER BY nulls DESC, "column" LIMIT 5)'
            for v in RAW
        ]),
        *RAW,
    ),
    "null_reduction": query(
        """SELECT *, raw_nulls - clean_nulls AS removed, CASE WHEN raw_nulls > 0
        THEN (raw_nulls - clean_nulls) / raw_nulls * 100 ELSE 0.0 END AS removed_pct FROM both_counts""",
        *CHECKED_VIEWS, **_ALL_CLEANED,
        both_counts=union([
            f"SELECT '{v}' AS \"table\", (SELECT {null_total(v, column_names(v))}) AS raw_nulls,"
            f" (SELECT {null_total(c, LEFT_OVER[v])}) AS clean_nulls"
            for v, c in REDUCED.items()
        ]),
    ),
    "verify_cleaned": query(_checks(), *CHECKED_VIEWS, **_ALL_CLEANED),
    "verify_on_write": query(f"SELECT * FROM ({_checks()}) WHERE \"check\" <> 'loaded'", *CHECKED_VIEWS, **_ALL_CLEANED),
    "verify_verdict": query(
        """SELECT "check", count(*) AS checked, CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS failed,
        bool_and(status <> 'FAIL') AS passed FROM checks GROUP BY "check"
        UNION ALL SELECT 'ALL', count(*), CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT),
        bool_and(status <> 'FAIL') FROM checks""",
        *CHECKED_VIEWS, **_ALL_CLEANED, checks=_checks(),
    ),
    "ratio_features": query(f"SELECT app_id, {RATIOS} FROM v_app", "v_app"),
    "scaled_features": query(
        "SELECT app_id, target, "
        + ", ".join(f"round((x.{c} - m.a_{c}) / m.s_{c}, 6) + 0.0 AS z_{c}" for c in SCALED)
        + " FROM x, m",
        "v_app",
        **CLEANED["v_app"],
        rated=f"SELECT *, {RATIOS} FROM clean_app",
        x="SELECT * FROM rated WHERE Credit_to_Income IS NOT NULL AND Annuity_to_Income IS NOT NULL",
        m="SELECT " + ", ".join(f"avg({c}) AS a_{c}, stddev_samp({c}) AS s_{c}" for c in SCALED) + " FROM x",
    ),
    "impute_mean": query(
        "SELECT app_id, "
        + ", ".join(f"round(coalesce({c}, (SELECT avg({c}) FROM v_app)), 4) AS {c}_imp" for c in ("amt_income", "amt_annuity"))
        + ", "
        + ", ".join(f"coalesce({c}, (SELECT CAST(trunc(avg({c})) AS INT) FROM v_app)) AS {c}_imp" for c in ("car_age", "house_age"))
        + " FROM v_app",
        "v_app",
    ),
    "split_80_20": query(
        "SELECT app_id, CASE WHEN ('0x' || substr(md5(CAST(app_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80"
        " THEN 'train' ELSE 'test' END AS part FROM v_app",
        "v_app",
    ),
    "auc_of_score": query(
        """SELECT round((sum(r) FILTER (WHERE target = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 8)::DOUBLE AS auc
        FROM ranked, counts GROUP BY n1, n0""",
        "v_app",
        ranked="""SELECT target, (rank() OVER (ORDER BY amt_credit)
            + (count(*) OVER (PARTITION BY amt_credit) - 1) / 2.0)::DOUBLE AS r FROM v_app""",
        counts="""SELECT count(*) FILTER (WHERE target = 1)::DOUBLE AS n1,
            count(*) FILTER (WHERE target = 0)::DOUBLE AS n0 FROM v_app""",
    ),
    "roundtrip_csv": query("SELECT * FROM v_app", "v_app"),
    "roundtrip_csv_inferred": query("SELECT app_id, amt_income, car_age, segment FROM v_app", "v_app"),
    "csv_rejected": query(
        union([
            f"SELECT 'readable' AS \"check\", 'v_bureau' AS \"table\", '{c}' AS subject, CASE WHEN count(*) FILTER (WHERE {lost}) = 0 THEN 'PASS' ELSE 'WARN' END"
            f" AS status, count(*) FILTER (WHERE {lost}) AS detail FROM v_bureau"
            for c in column_names("v_bureau")
            for lost in [{"amt_credit_sum": "bureau_id % 50 = 0", "days_credit": "bureau_id % 35 = 0"}.get(c, "false")]
        ]),
        "v_bureau",
    ),
    "roundtrip_parquet": query("SELECT * FROM v_card", "v_card"),
}
