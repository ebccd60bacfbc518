"""The same queries as ANSI SQL over the raw tables, for an independent check.

Each text is written from the definition, with plain windows and joins, and
shares nothing with the Spark jobs.
"""

from __future__ import annotations

from rebasket.functions.ratios import FEATURES

_RAW_COLUMNS = {
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

_PRODUCTS = """products as (
  select cast(dense_rank() over (order by p_name) as bigint) product_id, p_name product_name,
         split_part(p_name, ' ', 1) aisle, split_part(p_name, ' ', 2) department
  from (select distinct p_name from part) d)"""

_ORDERS = """i_orders as (
  select o_orderkey order_id, o_custkey user_id,
    case when row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) > 1 then 'prior'
         when o_custkey % 4 < 3 then 'train' else 'test' end eval_set,
    cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as bigint) order_number,
    cast(date_diff('day', prev_date, o_orderdate) as double) days_since_prior_order
  from (select o.*, lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) prev_date
        from orders o) o)"""

_LINES = """i_lines as (
  select l.l_orderkey order_id, p.product_id, min(l.l_linenumber) pos
  from lineitem l join part pt on l.l_partkey = pt.p_partkey
  join products p on pt.p_name = p.product_name
  group by l.l_orderkey, p.product_id),
order_products as (
  select l.order_id, l.product_id,
    cast(row_number() over (partition by l.order_id order by l.pos, l.product_id) as bigint) add_to_cart_order,
    case when row_number() over (partition by o.user_id, l.product_id order by o.order_number) > 1
         then 1 else 0 end reordered
  from i_lines l join i_orders o on l.order_id = o.order_id)"""

_PRIOR = """prior as (
  select a.*, b.product_id, b.add_to_cart_order, b.reordered
  from i_orders a join order_products b on a.order_id = b.order_id where a.eval_set = 'prior')"""

_REPEATS = """prior as (
  select a.*, l.l_suppkey product_id, cast(l.l_linenumber as bigint) add_to_cart_order,
         case when l.l_linenumber > 1 then 1 else 0 end reordered
  from i_orders a join lineitem l on a.order_id = l.l_orderkey where a.eval_set = 'prior')"""

_FEATURES = """uf1 as (
  select user_id, max(order_number) user_orders, sum(days_since_prior_order) user_period,
         avg(days_since_prior_order) user_mean_days_since_prior
  from i_orders group by user_id),
uf2 as (
  select user_id, count(product_id) user_total_products, count(distinct product_id) user_distinct_products,
    count(*) filter (where reordered = 1)
      / nullif(cast(count(*) filter (where order_number > 1) as double), 0) user_reorder_ratio
  from prior group by user_id),
up as (
  select user_id, product_id, count(*) up_orders, min(order_number) up_first_order,
         max(order_number) up_last_order, avg(add_to_cart_order) up_average_cart_position
  from prior group by user_id, product_id),
seq as (
  select *, rank() over (partition by user_id, product_id order by order_number) product_seq_time from prior),
prd as (
  select product_id, count(*) prod_orders, cast(sum(reordered) as bigint) prod_reorders,
    count(*) filter (where product_seq_time = 1) prod_first_orders,
    count(*) filter (where product_seq_time = 2) prod_second_orders
  from seq group by product_id),
joined as (
  select up.*, uf1.* exclude (user_id), uf2.* exclude (user_id), prd.* exclude (product_id)
  from up join prd on up.product_id = prd.product_id
  join uf1 on up.user_id = uf1.user_id join uf2 on up.user_id = uf2.user_id)"""

_MATRIX = """matrix as (
  select * exclude (prod_reorders, prod_first_orders, prod_second_orders),
    prod_second_orders / nullif(cast(prod_first_orders as double), 0) prod_reorder_probability,
    1 + prod_reorders / nullif(cast(prod_first_orders as double), 0) prod_reorder_times,
    prod_reorders / nullif(cast(prod_orders as double), 0) prod_reorder_ratio,
    user_total_products / nullif(cast(user_orders as double), 0) user_average_basket,
    up_orders / nullif(cast(user_orders as double), 0) up_order_rate,
    user_orders - up_last_order up_orders_since_last_order,
    up_orders / nullif(cast(user_orders - up_first_order + 1 as double), 0) up_order_rate_since_first_order
  from joined)"""

_LABELLED = """train_lines as (
  select op.order_id, op.product_id, op.reordered, o.user_id
  from order_products op join i_orders o on op.order_id = o.order_id where o.eval_set = 'train'),
candidates as (select user_id, order_id, eval_set from i_orders where eval_set <> 'prior'),
labelled as (
  select m.*, c.order_id, c.eval_set,
    cast(case when c.eval_set = 'train' then coalesce(t.reordered, 0) else t.reordered end as int) reordered
  from matrix m join candidates c on m.user_id = c.user_id
  left join (select user_id, product_id, max(reordered) reordered from train_lines group by all) t
    on m.user_id = t.user_id and m.product_id = t.product_id),
train as (select * from labelled where eval_set = 'train'),
test as (select * exclude (reordered) from labelled where eval_set = 'test')"""

_SCORE = "up_order_rate_since_first_order"

_STEPS = f"""steps as (
  select score, pos, neg,
    sum(pos) over (order by score rows between unbounded preceding and current row) - pos pos_below,
    sum(neg) over (order by score rows between unbounded preceding and current row) - neg neg_below,
    sum(pos) over () p, sum(neg) over () n
  from (select {_SCORE} score, count(*) filter (where reordered = 1) pos,
               count(*) filter (where reordered <> 1) neg from train group by 1))"""

_DECIDED = f"""decided as (
  select user_id, product_id, order_id, {_SCORE} prob,
    case when {_SCORE} > 0.21 then 1 else 0 end decision,
    cast(round_even({_SCORE}, 0) as int) rounded,
    case when {_SCORE} > 0.2 then 'Customer is likely to buy this product!'
         else 'Customer is unlikely to buy this product!' end verdict
  from test)"""

_GAPS = f"""case user_id % 7 when 0 then null when 1 then cast('nan' as double) when 2 then -0.2 when 3 then 1.3
    else {_SCORE} end"""

_REQUESTS = """requests as (
  select concat(o.user_id, ',', op.product_id) body
  from order_products op join i_orders o on op.order_id = o.order_id where o.eval_set <> 'prior'
  union all
  select concat(eval_set, ',', user_id) from i_orders where order_id not in (select order_id from order_products)
  union all
  select cast(user_id as varchar) from i_orders where order_id not in (select order_id from order_products)),
keyed as (
  select body, try_cast(split_part(body, ',', 1) as bigint) user_id,
         case when contains(body, ',') then try_cast(split_part(body, ',', 2) as bigint) end product_id
  from requests)"""

# a user buys again what was bought twice: the planted label of the model jobs
_PLANTED = "up_orders >= 2"


def _answer(told: str) -> str:
    return f"""case when {told} then 1 else 0 end decision,
    case when {told} then 'Customer is likely to buy this product!' else 'Customer is unlikely to buy this product!' end verdict"""


def _number(seed: str = "") -> str:
    """The first 60 bits of the key's md5."""
    return f"cast('0x' || substr(md5(concat({seed}user_id, '-', product_id)), 1, 15) as bigint)"


# five margins, forwards and backwards, of two models in three folds
_MARGIN_STEPS = ["up_orders * 1.0", "up_orders_since_last_order * -0.25", "user_orders * 0.125", "prod_orders * 0.0009765625", "up_first_order * -0.5"]
_MARGINS = "margins as (" + " union all ".join(
    f"select {row} as \"row\", {i + 1} as round, cast({' + '.join(steps[:i + 1])} as double) margin, reordered, "
    "cast('0x' || substr(md5(concat(user_id, '-', product_id)), 1, 8) as bigint) % 3 own from train"
    for row, steps in enumerate((_MARGIN_STEPS, _MARGIN_STEPS[::-1])) for i in range(5)) + ")"
_ROUND_AUC = """sides as (
  select "row", f.fold, round, own = f.fold test, margin, reordered from margins cross join (values (0), (1), (2)) f(fold)),
ranked as (
  select *, rank() over (partition by "row", fold, round, test order by margin)
    + (count(*) over (partition by "row", fold, round, test, margin) - 1) / 2.0 r from sides),
areas as (
  select "row", fold, round, test, (sum(r) filter (where reordered = 1) - count_if(reordered = 1) * (count_if(reordered = 1) + 1) / 2.0)
    / (cast(count_if(reordered = 1) as double) * count_if(reordered <> 1)) auc from ranked group by all),
log as (
  select cast("row" as int) "row", cast(fold as int) fold, cast(round as int) round, max(auc) filter (where test) test_auc,
    max(auc) filter (where not test) train_auc from areas group by all)"""
# the best of the first r rounds stands if no later round within two of a best one gained
_BEST_ROUNDS = """means as (select "row", round, avg(test_auc) m from log group by all),
bests as (
  select a."row", a.round, a.m from means a
  where not exists (select 1 from means b where b."row" = a."row" and b.round < a.round and b.m >= a.m)),
gaps as (
  select *, lead(round) over (partition by "row" order by round) next_round from bests),
stops as (
  select "row", min(round) best_round from gaps where next_round is null or next_round - round > 2 group by "row")"""

_SEGMENTS = """segments as (
  select pos, neg, p, p - pos_below - pos tp_a, n - neg_below - neg fp_a from steps)"""

_DENSITY = f"""scores as (select reordered label, {_SCORE} s from train where {_SCORE} is not null and not isnan({_SCORE})),
span as (select min(s) low, (max(s) - min(s)) / 511 step from scores),
shape as (
  select label, count(*) n, 0.9 * case when least(stddev_samp(s), (quantile_cont(s, 0.75) - quantile_cont(s, 0.25)) / 1.34) > 0
      then least(stddev_samp(s), (quantile_cont(s, 0.75) - quantile_cont(s, 0.25)) / 1.34)
      when stddev_samp(s) > 0 then stddev_samp(s) else 1.0 end * pow(count(*), -0.2) bw from scores group by label),
binned as (
  select label, round((s - low) / step) bin, count(*) here from scores, span group by all),
dense as (
  select b.label, g.point, sum(here * exp(-0.5 * pow((g.point - bin) * step / bw, 2)) / (sqrt(2 * pi()) * bw) / n) density
  from binned b join shape h on b.label is not distinct from h.label, span, range(512) g(point) group by all)"""

_BASE = [_PRODUCTS, _ORDERS, _LINES]
_TO_PRIOR = [*_BASE, _PRIOR]
_TO_JOINED = [*_TO_PRIOR, _FEATURES]
_TO_MATRIX = [*_TO_JOINED, _MATRIX]
_TO_LABELLED = [*_TO_MATRIX, _LABELLED]

_DOUBLES = ", ".join(f"cast(m.{c} as double) {c}" for c in FEATURES)
_PACKED = "concat_ws(',', " + ", ".join(f"coalesce(cast({c} as varchar), '')" for c in FEATURES) + ")"


def _sql(parts: list[str], select: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + select


def _profile() -> str:
    rows = [
        f"select '{table}' as \"table\", '{column}' as \"column\", '{kind}' as type, "
        f"(select count(*) from {table}) as rows, "
        f"(select count(*) from {table} where {column} is null) as nulls"
        for table, columns in _RAW_COLUMNS.items()
        for column, kind in (c.split(" ") for c in columns.split(", "))
    ]
    return "\nunion all\n".join(rows)


def _bucket(seed: str = "") -> str:
    return f"cast('0x' || substr(md5(concat({seed}user_id, '-', product_id)), 1, 8) as bigint) % 100"


def _shrinkage() -> str:
    grid = "grid(\"row\", k) as (values (0, 0), (1, 1), (2, 2), (3, 4))"
    scored = """scored as (
  select g."row", g.k, (up_orders + k * prod_reorder_ratio) / (user_orders - up_first_order + 1 + k) score,
         reordered from train cross join grid g)"""
    ranked = """ranked as (
  select "row", k, reordered, score, avg(rn) over (partition by "row", score) rk
  from (select *, row_number() over (partition by "row" order by score) rn from scored))"""
    auc = """aucs as (
  select "row", k, (sum(rk) filter (where reordered = 1) - p * (p + 1) / 2.0) / (cast(p as double) * n) auc
  from (select *, count(*) filter (where reordered = 1) over (partition by "row") p,
               count(*) filter (where reordered <> 1) over (partition by "row") n from ranked)
  group by "row", k, p, n)"""
    return _sql([*_TO_LABELLED, grid, scored, ranked, auc],
                'select cast("row" as int) "row", cast(k as int) k, auc, round(auc, 3) auc_shown from aucs')


def oracle_sql() -> dict[str, str]:
    lookup = _sql(
        [*_TO_MATRIX, _REQUESTS],
        f"""select k.body, k.user_id, k.product_id, {_DOUBLES},
  case when k.user_id is null or k.product_id is null then 'bad_request'
       when m.user_id is null then 'unknown_key' else 'ok' end status
from keyed k left join matrix m on k.user_id = m.user_id and k.product_id = m.product_id""")
    with_lines = """select o.*, op.product_id, op.add_to_cart_order, op.reordered
from i_orders o left join order_products op on o.order_id = op.order_id where o.eval_set = 'prior'"""
    seq = "select * replace (cast(product_seq_time as bigint) as product_seq_time) from seq"
    ties = [_ORDERS, _REPEATS, _FEATURES]
    train_columns = ", ".join(f"cast({c} as double) {c}" for c in FEATURES)
    decided = _answer(_PLANTED)
    told = f"select user_id, product_id, order_id, case when {_PLANTED} then 1 else 0 end rounded, {decided} from test"
    asked = _sql(
        [*_TO_MATRIX, _REQUESTS],
        f"""select k.body, k.user_id, k.product_id, case when k.user_id is null or k.product_id is null then 'bad_request'
       when m.user_id is null then 'unknown_key' else 'ok' end status,
  case when {_PLANTED} then 1 else 0 end decision,
  case when m.user_id is not null then case when {_PLANTED} then 'Customer is likely to buy this product!'
       else 'Customer is unlikely to buy this product!' end end verdict
from keyed k left join matrix m on k.user_id = m.user_id and k.product_id = m.product_id""")
    grid = "(values (0, 0.1, 0.7), (1, 0.1, 0.5), (2, 0.05, 0.7), (3, 0.05, 0.5)) g(\"row\", eta, gamma)"
    side = f"case when row_number() over (order by {_number()}, user_id, product_id) <= 1000 then 'held' else 'train' end"
    return {
        "profile_tables": _profile(),
        "csv_to_parquet": _sql([_ORDERS], "select * from i_orders"),
        "products": _sql([_PRODUCTS], "select * from products"),
        "orders_derived": _sql([_ORDERS], "select * from i_orders"),
        "order_products_derived": _sql(_BASE, "select * from order_products"),
        "orders_with_lines": _sql(_BASE, with_lines),
        "orders_with_lines_preview": _sql(
            _BASE, with_lines + " order by o.order_id, op.product_id nulls first limit 20"),
        "order_products_prior": _sql(_TO_PRIOR, "select * from prior"),
        "user_features_1": _sql(_TO_JOINED, "select * from uf1"),
        "user_features_2": _sql(_TO_JOINED, "select * from uf2"),
        "up_features": _sql(_TO_JOINED, "select * from up"),
        "product_seq_time": _sql(_TO_JOINED, seq),
        "product_seq_time_ties": _sql(ties, seq),
        "product_seq_time_hot": _sql(ties, seq),
        "prd_features": _sql(_TO_JOINED, "select * from prd"),
        "prd_features_ties": _sql(ties, "select * from prd"),
        "features_join": _sql(_TO_JOINED, "select * from joined"),
        "feature_matrix": _sql(_TO_MATRIX, "select * from matrix"),
        "train_lines": _sql(_TO_LABELLED, "select * from train_lines"),
        "candidate_orders": _sql(_TO_LABELLED, "select * from candidates"),
        "labelled": _sql(_TO_LABELLED, "select * from labelled"),
        "train_rows": _sql(_TO_LABELLED, "select * from train"),
        "test_rows": _sql(_TO_LABELLED, "select * from test"),
        "holdout_fit": _sql(_TO_LABELLED, f"select * from train where {_bucket()} >= 20"),
        "holdout_validation": _sql(_TO_LABELLED, f"select * from train where {_bucket()} < 20"),
        "sample": _sql(_TO_LABELLED, f"select * from train where {_bucket(chr(39) + '1-' + chr(39) + ', ')} < 10"),
        "roc_auc": _sql(
            [*_TO_LABELLED, _STEPS],
            "select cast(max(p) as bigint) positives, cast(max(n) as bigint) negatives, "
            "sum(pos * (neg_below + neg / 2.0)) / (cast(max(p) as double) * max(n)) auc from steps"),
        "roc_curve": _sql(
            [*_TO_LABELLED, _STEPS],
            "select score threshold, cast(p - pos_below as bigint) tp, cast(n - neg_below as bigint) fp, "
            "(p - pos_below) / cast(p as double) tpr, (n - neg_below) / cast(n as double) fpr from steps"),
        "pr_curve": _sql(
            [*_TO_LABELLED, _STEPS],
            "select score threshold, cast(p - pos_below as bigint) tp, cast(n - neg_below as bigint) fp, "
            "(p - pos_below) / cast(p - pos_below + n - neg_below as double) as \"precision\", "
            "(p - pos_below) / cast(p as double) recall from steps"),
        "score_distribution": _sql(
            _TO_LABELLED,
            f"""select label, bin, n, n * 20 / cast(sum(n) over (partition by label) as double) density
from (select reordered label, cast(least(floor({_SCORE} * 20), 19) as int) bin, count(*) n
      from train group by 1, 2)"""),
        "roc_auc_gaps": _sql(
            [*_TO_LABELLED, f"scored as (select {_GAPS} s, reordered y from train)",
             "judged as (select s, y from scored where s is not null and not isnan(s))",
             "ranked as (select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0 r from judged)"],
            "select count_if(y = 1) positives, count_if(y <> 1) negatives, "
            "(sum(r) filter (where y = 1) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0) "
            "/ (cast(count_if(y = 1) as double) * count_if(y <> 1)) auc from ranked"),
        "score_distribution_gaps": _sql(
            _TO_LABELLED,
            f"""select label, bin, n, n * 20 / cast(sum(n) over (partition by label) as double) density
from (select reordered label, cast(case when s < 0 then 0 when s >= 1 then 19 else floor(s * 20) end as int) bin, count(*) n
      from (select reordered, {_GAPS} s from train) where s is not null and not isnan(s) group by 1, 2)"""),
        "decide_gaps": _sql(
            [*_TO_LABELLED, f"scored as (select user_id, product_id, order_id, {_GAPS} s from test)"],
            """select user_id, product_id, order_id,
  case when s > 0.21 and not isnan(s) then 1 else 0 end decision,
  case when not isnan(s) then cast(round_even(case when isnan(s) then 0 else s end, 0) as int) end rounded,
  case when s > 0.2 and not isnan(s) then 'Customer is likely to buy this product!'
       else 'Customer is unlikely to buy this product!' end verdict from scored"""),
        "decide": _sql([*_TO_LABELLED, _DECIDED], "select * from decided"),
        "submission": _sql(
            [*_TO_LABELLED, _DECIDED],
            """select order_id, coalesce(string_agg(cast(product_id as varchar), ' ' order by product_id)
  filter (where decision = 1), 'None') products from decided group by order_id order by order_id"""),
        "tuning_results": _shrinkage(),
        "tuning_best": _shrinkage() + ' order by auc desc, "row" limit 1',
        "export_features": _sql(_TO_JOINED, "select * from joined"),
        "export_training": _sql(_TO_LABELLED, f"select reordered, {train_columns} from train"),
        "feature_store": _sql(_TO_MATRIX, f"select user_id, product_id, {_PACKED} feature from matrix"),
        "feature_store_unpacked": _sql(
            _TO_MATRIX, f"select m.user_id, m.product_id, {_DOUBLES} from matrix m"),
        "request_lookup": lookup,
        "request_lookup_stream": lookup,
        "request_lookup_stored": lookup,
        "request_lookup_joined": lookup,
        "fit_and_score": _sql(_TO_LABELLED, told),
        "fit_with_patience": _sql(
            _TO_LABELLED, f"select user_id, product_id, order_id, case when {_PLANTED} then 1 else 0 end decision from test"),
        "model_auc": _sql(
            _TO_LABELLED,
            f"""select side, count_if({_PLANTED}) positives, count_if(not {_PLANTED}) negatives, true good
from (select up_orders, {side} side from train) group by side"""),
        "tune_grid": f"""select cast("row" as int) "row", 100.0::double nrounds, 6.0::double max_depth, 0.95::double colsample_bytree,
  0.75::double subsample, 10.0::double min_child_weight, 1.0::double scale_pos_weight, eta::double eta, gamma::double gamma, true good from {grid}""",
        "tune_rounds": f"""select cast("row" as int) "row", cast(fold as int) fold, cast(round as int) round, true test_good, true train_good
from {grid}, range(3) f(fold), range(1, 21) r(round)""",
        "tune_random": 'select cast(r as int) "row", true in_ranges, true good from range(4) t(r)',
        "tune_model_based": 'select cast(r as int) "row", true in_ranges, true round_kept, true good from range(4) t(r)',
        "round_auc": _sql([*_TO_LABELLED, _MARGINS, _ROUND_AUC], "select * from log"),
        "best_rounds": _sql(
            [*_TO_LABELLED, _MARGINS, _ROUND_AUC, _BEST_ROUNDS],
            """select m."row", min(m.m) least_auc, s.best_round, max(m.m) filter (where m.round = s.best_round) best_auc
from means m join stops s on m."row" = s."row" group by all"""),
        "sample_exact": _sql(
            _TO_LABELLED,
            f"""select * exclude (r, c) from (select *, row_number() over (order by {_number("'1-', ")}, user_id, product_id) r, count(*) over () c from train)
where r <= round_even(c * 0.1, 0)"""),
        "holdout_exact": _sql(
            _TO_LABELLED, f"select *, row_number() over (order by {_number()}, user_id, product_id) <= 20000 held from train"),
        "folds": _sql(
            _TO_LABELLED,
            f"""select *, cast((row_number() over (partition by reordered order by {_number("'1-', ")}, user_id, product_id) - 1) % 3 as int) fold
from train"""),
        "score_density": _sql(
            [*_TO_LABELLED, _DENSITY],
            """select label, cast(point as int) point, round(low + point * step, 6) score, round(density, 6) density from dense, span"""),
        "pr_interpolated": _sql(
            [*_TO_LABELLED, _STEPS, _SEGMENTS],
            """select cast(k as int) point, k / 1000.0::double recall,
  (k * p / 1000.0::double) / (k * p / 1000.0::double + fp_a + neg / pos::double * (k * p / 1000.0::double - tp_a)) as "precision"
from segments join range(1, 1001) g(k) on tp_a * 1000 < k * p and k * p <= (tp_a + pos) * 1000
union all
select 0, 0.0, pos / (pos + neg)::double from segments where tp_a = 0 and fp_a = 0"""),
        "pr_auc": _sql(
            [*_TO_LABELLED, _STEPS, _SEGMENTS],
            """select cast(max(p) as bigint) positives, cast(sum(neg) as bigint) negatives, sum(case when pos = 0 then 0
  when fp_a * pos = neg * tp_a then pos / (1 + neg / pos::double)
  else pos / (1 + neg / pos::double) - (fp_a - neg / pos::double * tp_a) / (1 + neg / pos::double) ** 2
    * ln((tp_a + pos + fp_a + neg) / (tp_a + fp_a)::double) end) / max(p)::double pr_auc from segments"""),
        "crawl_again": _sql(
            [_ORDERS],
            "select order_id, user_id, eval_set, order_number, case when eval_set <> 'prior' then days_since_prior_order end days_since_prior_order from i_orders"),
        "score_requests": asked,
        "score_vectors": _sql(
            _TO_LABELLED + [f"packed as (select user_id, up_orders, {_PACKED} body from test)"],
            f"""select body, 'ok' status, {decided} from packed
union all select array_to_string(list_slice(string_split(body, ','), 1, 17), ','), 'bad_request', 0, null from packed where user_id % 3 = 0
union all select 'many,' || array_to_string(list_slice(string_split(body, ','), 2, 18), ','), 'bad_request', 0, null from packed where user_id % 3 = 1"""),
        "refresh_on_arrival": _sql(_TO_JOINED, "select * from joined"),
        "refresh_redelivered": _sql(_TO_JOINED, "select * from joined"),
        "refresh_closed_orders": _sql(_TO_JOINED, "select * from joined"),
    }
