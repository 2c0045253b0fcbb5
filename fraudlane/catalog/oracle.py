"""DuckDB SQL that answers the registered queries from the same tables."""

from __future__ import annotations

from ..functions.features import FEATURE_COUNT, FEATURES, feature_names
from ..functions.scoring import SINGLE_CUT, SUM_CUT, VOTES_NEEDED
from ..plans.training import GRID_DEPTHS, GRID_TREES, SINGLE_TREES
from ..plans.runs import SINGLE_CUTS, SUM_CUTS
from ..plans.transactions import AMOUNT_CUTS, LABEL_AMOUNT_RANGE, LABEL_SUM
from . import queries as q

_RANGES = " ".join(
    f"when value >= {cut} then {i}" for i, cut in reversed(list(enumerate(AMOUNT_CUTS, start=1)))
)
_PCA = ", ".join(f"b.embedding[{i + 1}]::double as pca{i}" for i in range(FEATURE_COUNT))
_FEATURE_LIST = ", ".join(FEATURES)


def _votes(single: float = SINGLE_CUT, total: float = SUM_CUT) -> str:
    conditions = (f"pca0 > {single}", f"pca1 > {single}", f"pca0 + pca1 > {total}")
    votes = " + ".join(f"case when {c} then 1 else 0 end" for c in conditions)
    return f"cast(case when {votes} >= {VOTES_NEEDED} then 1 else 0 end as int)"


def _renamed(style: str) -> str:
    return ", ".join(f'{s} as "{n}"' for s, n in zip(FEATURES, feature_names(style)))


_TXN = f"""
with counted as (
  select count(*) as n_vectors from embeddings
), started as (
  select min(epoch_us(ts)) as first_us from events
), shaped as (
  select event_id as id, event_id % n_vectors as vector_id,
         cast((epoch_us(ts) - first_us) // 1000000 as int) as "time",
         cast(case {_RANGES} else 0 end as int) as amountRange
  from events, counted, started
), featured as (
  select e.* exclude (vector_id), {_PCA}
  from shaped e join embeddings b on e.vector_id = b.vec_id
), txn as materialized (
  select *, cast(case when pca0 + pca1 > {LABEL_SUM} and amountRange >= {LABEL_AMOUNT_RANGE}
                 then 1 else 0 end as int) as label
  from featured
), scored as (
  select *, {_votes()} as prediction from txn
), gold as (
  select id, "time", amountRange, prediction from scored
)"""


def _bucket(seed: int) -> str:
    digest = f"md5(cast(id as varchar) || ':{seed}')"
    return f"cast('0x' || substr({digest}, 1, 8) as bigint) % 10000"


def _part(shares: dict[str, float], seed: int) -> str:
    return f"case when {_bucket(seed)} < {round(shares['train'] * 10000)} then 'train' else 'test' end"


def _by_digest(seed: int) -> str:
    return f"md5(cast(id as varchar) || ':{seed}'), id"


def _rates(scale: float, counted: str, by: str = "") -> str:
    """Rates from counts tn, fp, fn, tp."""
    def ratio(a: str, b: str) -> str:
        return f"case when {b} = 0 then 0.0::double else ({a})::double / ({b})::double end * {scale}::double"

    return (
        f"select {by} {ratio('tp + tn', '(tn + fp + fn + tp)')} as accuracy, "
        f"{ratio('tp', '(tp + fp)')} as \"precision\", {ratio('tp', '(tp + fn)')} as recall, "
        f"{ratio('2 * tp', '(2 * tp + fp + fn)')} as f1_score from {counted}"
    )


_COUNTS = """count(*) filter (where label = 0 and prediction = 0) as tn,
  count(*) filter (where label = 0 and prediction = 1) as fp,
  count(*) filter (where label = 1 and prediction = 0) as fn,
  count(*) filter (where label = 1 and prediction = 1) as tp"""


def _cells_of(source: str, extra: str = "") -> str:
    return " union all ".join(
        f"select cast(id as varchar) as row_key, 'predict' as family, '{name}' as qualifier, "
        f"cast(\"{name}\" as varchar) as value, {extra} from {source}"
        for name in q.QUALIFIERS
    )


def _round_all(digits: int, source: str, lead: str = "") -> str:
    metrics = ("accuracy", "precision", "recall", "f1_score")
    rounded = ", ".join(f'round("{m}", {digits}) as "{m}"' for m in metrics)
    return f"select {lead} {rounded} from {source}"


def _runs(source: str, by: str = "") -> str:
    """Nine threshold rules, evaluated and numbered as runs."""
    settings = [(s, t) for s in SINGLE_CUTS for t in SUM_CUTS]
    group = f"group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    parts = []
    for i, (single, total) in enumerate(settings, start=1):
        counted = (
            f"(select {lead} {_COUNTS} from (select {lead} label, {_votes(single, total)} as prediction "
            f"from {source}) p {group}) c"
        )
        run = f"{lead} {i} as run_no, 'cuts_{i:02d}' as run_key, {single}::double as single_cut, {total}::double as sum_cut,"
        parts.append(_rates(100.0, counted, run))
    return " union all ".join(parts)


# Prediction and truth of a row are joined by its id there; here they come from one scan.
_WRONG = "scored p where p.prediction <> p.label"
_GOLD = "select id, \"time\", amountRange, prediction from gold"
_TEST_ROWS = f"(select * from txn where {_part(q.TRAIN_TEST, q.TRAIN_TEST_SEED)} = 'test')"
_TEST_LABELS = f"select label, count(*) as n_rows, 0::bigint as n_out_of_range, 0::bigint as n_changed from {_TEST_ROWS} group by label"
_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)
_LINES = "(select l_quantity, l_extendedprice from lineitem)"
_IN_RANGE = f"l_quantity between {q.CARAT_LOW} and {q.CARAT_HIGH}"


def _pairs() -> str:
    rows = []
    for i, a in enumerate(FEATURES):
        for b in FEATURES[i + 1 :]:
            rows.append(
                f"select label, '{a}' as column_a, '{b}' as column_b, "
                f"round(corr({a}, {b}), 6) as correlation from txn group by label"
            )
    return " union all ".join(rows)


def _literals() -> str:
    block = f"id // {q.BLOCK_ROWS}"
    return " union all ".join(
        f"select {block} as block, '{n}' as column_name, "
        f"string_agg(printf('%.6f', {n}), ', ' order by id) as literal from txn group by 1"
        for n in FEATURES
    )


def _answers() -> str:
    """One answer for each request: predictions in order, and the faults of its records."""
    kind = f"id % {len(q.REQUEST_DAMAGES)}"
    faults = " ".join(f"when {kind} = {i} then '{fault}'" for i, (_, _, fault) in enumerate(q.REQUEST_DAMAGES) if fault)
    return f"""select request_id, '{{"predictions":[' || predictions || ']' ||
            case when errors is null then '' else ',"errors":["' || errors || '"]' end || '}}' as response from (
          select request_id, string_agg(case when fault is null then cast(prediction as varchar) else 'null' end, ',' order by id) as predictions,
            string_agg('record ' || id % {q.REQUEST_RECORDS} || ': ' || fault, '","' order by id) filter (where fault is not null) as errors
          from (select id, prediction, id // {q.REQUEST_RECORDS} as request_id, case {faults} end as fault from scored)
          group by request_id)"""


def oracle_queries() -> dict[str, str]:
    gold_as_cells = _cells_of("numbered", f"{q.FIRST_STAMP}::bigint as stamp_us, batch_no")
    numbered = f"select *, (row_number() over (order by id) - 1) // {q.BATCH_ROWS} as batch_no from gold"
    responses = f"""select id // {q.REQUEST_RECORDS} as request_id,
        '{{"predictions":[' || string_agg(cast(prediction as varchar), ',' order by id) || ']}}' as response
        from scored group by 1"""
    newest = _cells_of(
        f"(select id, \"time\", amountRange, {_votes(q.LOOSE_CUT)} as prediction from txn) l",
        f"{q.FIRST_STAMP}::bigint as stamp_us",
    ) + " union all " + _cells_of(
        f"(select * from gold where amountRange > {q.REWRITE_ABOVE}) g",
        f"{q.SECOND_STAMP}::bigint as stamp_us",
    )
    on_txn = {
        "scan_txn": "select * from txn",
        "csv_round_trip": _GOLD,
        "preview_table": f"select * from txn order by id limit {q.PREVIEW_ROWS}",
        "warehouse_slice": f'select id, "time", amountRange, {_renamed("warehouse")} from txn where id <= {q.WAREHOUSE_LAST_ID}',
        "warehouse_round_trip": f'select id, "time", amountRange, {_renamed("warehouse")} from txn',
        "columns_to_rows": f"select id, {_FEATURE_LIST} from txn",
        "payload_rows": f"""select id // {q.REQUEST_RECORDS} as request_id,
            cast(row_number() over (partition by id // {q.REQUEST_RECORDS} order by id) - 1 as int) as position,
            {_FEATURE_LIST} from txn""",
        "bronze": f'select "time", amountRange, label, {_renamed("flattened")} from txn',
        "silver": f"""select row_number() over (order by "time", amountRange, label, {_FEATURE_LIST}) as id,
            "time", amountRange, label, {_FEATURE_LIST} from txn""",
        "gold": _GOLD,
        "valid_table": f'select id, "time", amountRange, {_renamed("flattened")}, label from txn',
        "test_table": f'select id, "time", amountRange, {_renamed("flattened")} from txn',
        "table_lifecycle": """select 1 as step_no, 'created' as step, 0::bigint as n_rows
            union all select 2, 'inserted', count(*) from txn
            union all select 3, 'emptied', 0 union all select 4, 'dropped', 0""",
        "predictions_view": _GOLD,
        "kv_cells": f"select * from (with numbered as ({numbered}) {gold_as_cells})",
        "kv_batches": f"""select batch_no, count(*) as n_rows, {len(q.QUALIFIERS)} * count(*) as n_mutations,
            min(id) as first_key, max(id) as last_key from ({numbered}) group by batch_no""",
        "kv_latest": f"""select row_key, family, qualifier, value, stamp_us from (
            select *, row_number() over (partition by row_key, family, qualifier order by stamp_us desc) as rn
            from ({newest})) where rn = 1""",
        "kv_lookup": f"""select cast(p.id as varchar) as row_key, cast(p.prediction as varchar) as prediction,
            cast(p."time" as varchar) as "time", cast(p.amountRange as varchar) as amountRange from {_WRONG}""",
        "kv_lookup_column": f"""select cast(p.id as varchar) as row_key,
            cast(p.amountRange as varchar) as amountRange from {_WRONG}""",
        "kv_row": f"""select cast(id as varchar) as row_key, cast(prediction as varchar) as prediction,
            cast("time" as varchar) as "time", cast(amountRange as varchar) as amountRange
            from gold where id = {q.SCORE_ABOVE_ID}""",
        "kv_count": "select count(distinct id) as n_rows from gold",
        "flatten_features": f'select "time", amountRange, label, {_renamed("flattened")} from txn',
        "valid_labels": 'select id, "time", amountRange, label from txn',
        "surrogate_id": """select row_number() over (order by amountRange, id) as surrogate_id,
            amountRange, id, "time", label from txn""",
        "feature_slice": f"select {_FEATURE_LIST}, id from txn",
        "rename_features": f'select id, "time", amountRange, {_renamed("warehouse")}, label from txn',
        "score_struct": "select id, prediction::double as predictions from scored",
        "row_slice": f"""select label, {", ".join(FEATURES[:10])} from txn
            where id between {q.FIRST_ROW} and {q.LAST_ROW}""",
        "parameterised_sql": f"{_GOLD} where amountRange > {q.REWRITE_ABOVE}",
        "rows_to_columns": _literals(),
        "payload_response": responses,
        "payload_response_udf": responses,
        "batch_stamp": f"""select {len(q.QUALIFIERS)} * count(*) as n_cells, 1::bigint as n_stamps,
            0::bigint as n_other_seconds from gold""",
        "score_id_range": f"{_GOLD} where id > {q.SCORE_ABOVE_ID} and id < (select max(id) from gold)",
        "score_test": _GOLD,
        "score_warehouse": _GOLD,
        "gold_fraud": f"{_GOLD} where prediction = 1",
        "gold_clean": f"{_GOLD} where prediction = 0",
        "high_value_fraud": f"""select id, "time", amountRange from gold
            where amountRange > {q.HIGH_AMOUNT_RANGE} and prediction = 1""",
        "mispredictions": f'select p.id, p."time", p.amountRange, p.prediction, p.label from {_WRONG}',
        "mispredictions_by_range": """select p.id, p.amountRange as range, p.prediction, v.label from scored p
            join (select distinct amountRange, label from txn) v on p.amountRange = v.amountRange where p.prediction <> v.label""",
        "masked_rows": f"select id, {_FEATURE_LIST} from txn where label = 1",
        "false_positive_count": f"select count(p.id) as false_positive_count from {_WRONG} and p.prediction = 1",
        "row_count": "select count(*) as n_rows from txn",
        "label_counts": "select label, count(*) as n_rows from txn group by label",
        "distinct_labels": "select distinct label from txn",
        "confusion_matrix": """select g.label, g.prediction, count(s.id) as n_rows
            from (select unnest([0, 0, 1, 1]) as label, unnest([0, 1, 0, 1]) as prediction) g
            left join scored s on s.label = g.label and s.prediction = g.prediction group by 1, 2""",
        "eval_metrics": _round_all(5, f"({_rates(1.0, f'(select {_COUNTS} from scored)')})"),
        "eval_metrics_percent": _round_all(5, f"({_rates(100.0, f'(select {_COUNTS} from scored)')})"),
        "split_shapes": f"""select part, n_rows, frame, n_columns from (
              select {_part(q.TRAIN_TEST, q.TRAIN_TEST_SEED)} as part, count(*) as n_rows from txn group by 1) c,
            (values ('features', {FEATURE_COUNT}), ('label', 1)) f(frame, n_columns)""",
        "imbalance": """select count(*) as n_rows, cast(sum(label) as bigint) as n_positive,
            round(avg(label) * 100.0::double, 3) as positive_percent from txn""",
        "pairwise_corr": _pairs(),
        "random_sample": f"""select id, label, {", ".join(FEATURES)} from txn
            order by {_by_digest(q.SAMPLE_SEED)} limit {q.MIXED_ROWS}""",
        "stratified_sample": f"""select id, label, {", ".join(FEATURES)} from (
            (select * from txn order by {_by_digest(q.SAMPLE_SEED)} limit {q.MIXED_ROWS}) union all
            (select * from txn where label = 1 order by {_by_digest(q.SAMPLE_SEED)} limit {q.FRAUD_ROWS}))""",
        "hash_split": f"select id, label, {_part(q.TRAIN_TEST, q.TRAIN_TEST_SEED)} as part from txn",
        "holdout_split": f"select id, label, {_part(q.HOLDOUT, q.HOLDOUT_SEED)} as part from txn",
        "scoring_sample": f"""select * from (
            (select * from txn where {_part(q.HOLDOUT, q.HOLDOUT_SEED)} = 'test'
             order by id limit {q.SCORING_ROWS}) union all
            (select * from txn where {_part(q.HOLDOUT, q.HOLDOUT_SEED)} = 'test' and label = 1
             order by id limit {q.SCORING_ROWS}))""",
        "identity_appends": f"""select row_number() over (order by amountRange > {q.REWRITE_ABOVE}, "time", amountRange, {_FEATURE_LIST}, label) as id,
            "time", amountRange, {_FEATURE_LIST}, label from txn""",
        "payload_contract": _answers(),
        "rf_likelihood": f"""select count(*) as n_rows, round(var_pop(label::double), 9) as baseline_error, 1 as beats_baseline,
            0::bigint as n_out_of_range from {_TEST_ROWS}""",
        "rf_calibration": f"""select count(*) as n_rows, round(avg(label), 9) as positive_share, 0::bigint as n_misplaced from {_TEST_ROWS}""",
        "rf_predictions": _TEST_LABELS,
        "rf_probability": _TEST_LABELS,
        "grid_runs": f"""select 'depth' || lpad(d::varchar, 2, '0') || '_trees' || lpad(t::varchar, 3, '0') as run_key,
            d as max_depth, t as n_estimators, n_negative, n_positive, 0 as n_beyond
            from (select unnest([{", ".join(map(str, GRID_DEPTHS))}]) as d), (select unnest([{", ".join(map(str, GRID_TREES))}]) as t),
              (select count(*) filter (where label = 0) as n_negative, count(*) filter (where label = 1) as n_positive
               from {_TEST_ROWS})""",
        "model_chain": f"""select count(*) as n_rows, 0::bigint as n_out_of_range,
            {len(GRID_DEPTHS) * len(GRID_TREES)}::bigint as n_runs, 1 as version, 'Production' as stage from txn""",
        "model_round_trip": f"select count(*) as n_rows, 0::bigint as n_different from {_TEST_ROWS}",
        "model_sql_scores": f"select count(*) as n_rows, 0::bigint as n_different from {_TEST_ROWS}",
        "schema_contract": f"select id, {_FEATURE_LIST} from txn",
        "best_run": _round_all(
            4,
            f"(select * from ({_runs(_TEST_ROWS)}) order by f1_score desc, run_key limit 1)",
            "'cc_fraud' as project, 'test' as run_group, run_key, single_cut, sum_cut,",
        ),
        "production_version": f"""select model, version, run_key, 'Production' as stage from (
            select *, row_number() over (partition by model order by version desc) as rn from (
              select 'cc_fraud_' || amountRange as model, run_no as version, run_key, f1_score,
                     max(f1_score) over (partition by amountRange order by run_no
                       rows between unbounded preceding and 1 preceding) as before
              from ({_runs("txn", "amountRange")}))
            where before is null or f1_score > before) where rn = 1""",
        "stream_scoring": _GOLD,
        "stream_upsert": f"""select cast(id as varchar) as row_key,
            cast(case when amountRange > {q.REWRITE_ABOVE} then prediction else {_votes(q.LOOSE_CUT)} end as varchar) as prediction,
            cast("time" as varchar) as "time", cast(amountRange as varchar) as amountRange from scored""",
    }
    on_txn["kv_compaction"] = on_txn["kv_latest"]
    on_txn["high_value_fraud_udf"] = on_txn["high_value_fraud"]
    on_txn["mispredictions_bucketed"] = on_txn["mispredictions"]
    direct = {
        "file_inventory": f"""select unnest(string_split('{_TABLES}', ' ')) as table_name, 1::bigint as n_files,
            0::bigint as n_empty""",
        "table_detail": "select 'parquet' as format, 1::bigint as n_files, 1 as found",
        "feature_importance": f"""select unnest(['{"', '".join(FEATURES)}']) as feature, 1 as agrees""",
        "tree_nodes": f"""select unnest(range({SINGLE_TREES}))::int as tree_id, 1::bigint as n_roots, 1::bigint as leaf_excess,
            0::bigint as n_dangling""",
        "csv_range_scan": f"select l_quantity as carat, l_extendedprice as price from {_LINES} where {_IN_RANGE}",
        "explicit_schema_rows": """select cast(c_custkey as int) as "CustomerID",
            split_part(c_name, '#', 1) as "FirstName", split_part(c_name, '#', 2) as "LastName" from customer""",
        "external_table_scan": "select * from events",
        "namespace_names": f"""select c_custkey, user_name, database_name,
            substr(split_part(database_name, '_', 1), 1, 1) || substr(split_part(database_name, '_', 2), 1, 1)
              || '_catalog' as catalog_name
            from (select *, regexp_replace(regexp_extract(user_name, '^(.+)@[^@]*$', 1), '\\W+', '_', 'g')
                  as database_name from (
              select c_custkey, c_name || '{q.USER_DOMAIN}' as user_name from customer))""",
        "range_select": f"select l_quantity, l_extendedprice from {_LINES} where {_IN_RANGE}",
        "smoothed_means": f"""select cast(floor(l_quantity / {q.X_WIDTH}) as bigint) as x_bin, count(*) as n_rows,
            round(avg(l_extendedprice), 4) as mean_y,
            round(stddev_samp(l_extendedprice) / sqrt(count(*)), 4) as standard_error
            from {_LINES} where {_IN_RANGE} group by 1""",
        "smoothed_curve": f"""with r as (
              select floor(l_quantity / {q.X_WIDTH}) as b, l_quantity::double as x, l_extendedprice::double as y from {_LINES} where {_IN_RANGE}),
            a as (select avg(y) as level from r),
            p as (
              select c.b, r.b = c.b as own, power(1 - power(abs(r.b - c.b) / {q.SMOOTH_REACH + 1}, 3), 3) as w,
                r.x - (c.b + 0.5) * {q.X_WIDTH} as u, r.y - a.level as v
              from r join (select distinct b from r) c on abs(r.b - c.b) <= {q.SMOOTH_REACH}, a),
            s as (
              select b, count(*) filter (where own) as n_rows, count(*) as m, sum(w) as s0, sum(w * u) as s1, sum(w * u * u) as s2,
                sum(w * v) as t0, sum(w * u * v) as t1, sum(w * v * v) as q, sum(w * w) as w0, sum(w * w * u) as w1, sum(w * w * u * u) as w2
              from p group by b),
            f as (
              select *, (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) as b0, (s0 * t1 - s1 * t0) / (s0 * s2 - s1 * s1) as b1 from s)
            select cast(b as bigint) as x_bin, n_rows, round(b0 + level, 4) as smooth_y,
              round(sqrt((q - b0 * t0 - b1 * t1) / s0 * m / (m - 2) * (s2 * s2 * w0 - 2 * s1 * s2 * w1 + s1 * s1 * w2)
                / power(s0 * s2 - s1 * s1, 2)), 4) as standard_error from f, a""",
        "scatter_bins": f"""select cast(floor(l_quantity / {q.X_WIDTH}) as bigint) as x_bin,
            cast(floor(l_extendedprice / {q.Y_WIDTH}) as bigint) as y_bin, count(*) as n_rows
            from {_LINES} group by 1, 2""",
    }
    return {name: f"{_TXN}\n{sql}" for name, sql in on_txn.items()} | direct
