"""The same queries as plain SQL for an independent engine."""

from __future__ import annotations

from nextpick.plans.registry import FIRST_STAGE_CODES, SECOND_STAGE_MINIMUM, TREND_MONTHS

ORACLE: dict[str, str] = {}
_ALL_CODES = range(1, 26)
_TARGET_CODES = range(1, 23)
_EXCLUDED = "product_class <> 'PROMO' AND category NOT IN ('Brand#1', 'Brand#2', 'Brand#3')"


def _elapsed(day: str, month: str) -> str:
    end = f"DATE '{month}'"
    return (f"(CAST((year({end}) - year({day})) * 12 + month({end}) - month({day})"
            f" - CASE WHEN {day} <= {end} AND day({day}) > 1 THEN 1 ELSE 0 END AS INTEGER))")


def _month(name: str, first: str, split_day: str, end: str) -> dict[str, str]:
    """CTEs of one reference month: population, encoded history and target, features."""
    nation = "CASE WHEN c_nationkey <> 24 THEN CAST(c_nationkey AS VARCHAR) END" if name == "dev" \
        else "CAST(c_nationkey AS VARCHAR)"
    months = _elapsed("contract_date", first)
    return {
        f"{name}_customers": f"""
            SELECT c_custkey AS customer_id, c_name AS identity_code,
                   '{first[:4]}{first[5:7]}' AS ref_month,
                   CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS segment,
                   {nation} AS nation, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance
            FROM customer""",
        f"{name}_history_raw": f"SELECT * FROM contracts WHERE contract_date < DATE '{split_day}'",
        f"{name}_target_all": f"""
            SELECT * FROM contracts
            WHERE contract_date >= DATE '{split_day}' AND contract_date < DATE '{end}'""",
        f"{name}_target_raw": f"SELECT * FROM {name}_target_all WHERE {_EXCLUDED}",
        f"{name}_ids": f"""
            SELECT customer_id FROM {name}_customers
            WHERE customer_id IN (SELECT customer_id FROM {name}_history_raw)
              AND customer_id IN (SELECT customer_id FROM {name}_target_raw)""",
        f"{name}_history_all": f"""
            SELECT DISTINCT h.customer_id, h.category, l.code AS category_code, h.contract_date
            FROM {name}_history_raw h LEFT JOIN label_codes l USING (category)""",
        f"{name}_target_coded": f"""
            SELECT DISTINCT t.customer_id, t.category, l.code AS category_code, t.contract_date
            FROM {name}_target_raw t LEFT JOIN (SELECT * FROM label_codes WHERE in_target = 1) l USING (category)""",
        f"{name}_history": f"SELECT * FROM {name}_history_all WHERE customer_id IN (SELECT customer_id FROM {name}_ids)",
        f"{name}_target": f"SELECT * FROM {name}_target_coded WHERE customer_id IN (SELECT customer_id FROM {name}_ids)",
        f"{name}_newest": f"""
            SELECT customer_id, category_code, row_number() OVER (
                       PARTITION BY customer_id ORDER BY contract_date DESC, category_code) AS place
            FROM {name}_history""",
        f"{name}_last": "SELECT customer_id, " + ", ".join(
            f"coalesce(max(CASE WHEN place = {n} THEN category_code END), 0) AS product_{n}" for n in range(1, 6))
            + f" FROM {name}_newest GROUP BY customer_id",
        f"{name}_summary": f"""
            SELECT customer_id, count(*) AS pre_contract_count, min({months}) AS pre_contract_month_min,
                   max({months}) AS pre_contract_month_max
            FROM {name}_history GROUP BY customer_id""",
        f"{name}_raw": f"""
            SELECT * FROM {name}_customers JOIN {name}_ids USING (customer_id)
            JOIN {name}_last USING (customer_id) JOIN {name}_summary USING (customer_id)""",
        f"{name}_positives": f"SELECT DISTINCT customer_id, category_code FROM {name}_target",
    }


_NUMERIC = ["balance", "pre_contract_count", "pre_contract_month_min", "pre_contract_month_max"]
_PRODUCTS = [f"product_{n}" for n in range(1, 6)]


def _scaled(column: str) -> str:
    return (f"CASE WHEN high_{column} = low_{column} THEN CAST({column} AS DOUBLE) - low_{column}"
            f" ELSE (CAST({column} AS DOUBLE) - low_{column}) / (high_{column} - low_{column}) END AS {column}")


def _encoded(name: str) -> str:
    return f"""
        SELECT customer_id, ref_month,
               coalesce(s.code, (SELECT code FROM category_encoder WHERE feature = 'segment' AND value = 'unknown'))
                   AS segment,
               coalesce(n.code, (SELECT code FROM category_encoder WHERE feature = 'nation' AND value = 'unknown'))
                   AS nation,
               {", ".join(_scaled(c) for c in _NUMERIC)}, {", ".join(_PRODUCTS)}
        FROM {name}_raw r
        LEFT JOIN category_encoder s ON s.feature = 'segment' AND s.value = r.segment
        LEFT JOIN category_encoder n ON n.feature = 'nation' AND n.value = r.nation
        CROSS JOIN ranges"""


def _scored(pairs: str, history: str) -> str:
    """Pairs with the count-based score."""
    return f"""
        SELECT p.*, (coalesce(h.held, 0) + coalesce(s.share, 0)) / (coalesce(t.total, 0) + 1) AS score,
               CASE WHEN h.held IS NULL THEN 0 ELSE 1 END AS has_item
        FROM {pairs} p
        LEFT JOIN (SELECT customer_id, category_code AS target_category, count(*) AS held
                   FROM {history} GROUP BY ALL) h USING (customer_id, target_category)
        LEFT JOIN (SELECT customer_id, count(*) AS total FROM {history} GROUP BY ALL) t USING (customer_id)
        LEFT JOIN shares s USING (target_category)"""


def _best(scored: str) -> str:
    return f"""
        SELECT customer_id, target_category, score FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, target_category) AS place
            FROM {scored}) WHERE place = 1"""


def _report(evaluated: str, truth: str) -> str:
    return f"""
        SELECT category, true_cnt, round(true_cnt / (SELECT count(*) FROM {truth}) * 100, 1) AS true_pct,
               coalesce(pred_cnt, 0) AS pred_cnt,
               coalesce(round(pred_cnt / (SELECT count(pred_item) FROM {evaluated}) * 100, 1), 0) AS pred_pct,
               coalesce(pred_true, 0) AS pred_true,
               round(coalesce(pred_true, 0) / nullif(coalesce(pred_cnt, 0), 0) * 100, 1) AS accuracy_pred,
               round(coalesce(pred_true, 0) / true_cnt * 100, 1) AS accuracy_true
        FROM (SELECT category, count(*) AS true_cnt FROM {truth} GROUP BY category)
        LEFT JOIN (SELECT pred_item AS category, count(*) AS pred_cnt, CAST(sum(hit) AS BIGINT) AS pred_true
                   FROM {evaluated} GROUP BY pred_item) USING (category)"""


def _hits(picks: str, truth: str) -> str:
    return f"""
        SELECT p.*, CASE WHEN t.category IS NULL THEN 0 ELSE 1 END AS hit
        FROM {picks} p LEFT JOIN {truth} t ON t.customer_id = p.customer_id AND t.category = p.pred_item"""


def _accuracy(evaluated: str) -> str:
    return f"""SELECT count(*) AS customers, CAST(sum(hit) AS BIGINT) AS hits,
                      round(sum(hit) / count(*) * 100, 1) AS accuracy FROM {evaluated}"""


_CTES = {
    "contracts": """
        SELECT o_custkey AS customer_id, l_partkey AS product_code, p_type AS product_class, p_brand AS category,
               CAST(o_orderdate AS DATE) AS contract_date, o_orderpriority, o_orderstatus, l_returnflag, l_linestatus
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "label_target": f"""
        SELECT category, count(*) AS n FROM (
            SELECT DISTINCT customer_id, product_code, product_class, category, contract_date FROM contracts
            WHERE contract_date >= DATE '2000-01-01' AND contract_date < DATE '2000-07-01' AND {_EXCLUDED})
        GROUP BY category""",
    "label_codes": """
        SELECT category, in_target, CAST(row_number() OVER (ORDER BY in_target DESC, n DESC, category) AS INTEGER) AS code
        FROM (SELECT category, n, 1 AS in_target FROM label_target
              UNION ALL
              SELECT category, count(*) AS n, 0 FROM contracts
              WHERE contract_date < DATE '2000-01-01' AND category NOT IN (SELECT category FROM label_target)
              GROUP BY category)""",
    **_month("dev", "1999-12-01", "2000-01-01", "2000-07-01"),
    **_month("later", "2000-12-01", "2001-01-01", "2001-07-01"),
    "category_encoder": """
        SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS INTEGER) AS code
        FROM (SELECT 'segment' AS feature, segment AS value FROM dev_raw WHERE segment IS NOT NULL
              UNION SELECT 'nation', nation FROM dev_raw WHERE nation IS NOT NULL
              UNION SELECT 'segment', 'unknown' UNION SELECT 'nation', 'unknown')""",
    "ranges": "SELECT " + ", ".join(
        f"CAST(min({c}) AS DOUBLE) AS low_{c}, CAST(max({c}) AS DOUBLE) AS high_{c}" for c in _NUMERIC)
        + " FROM dev_raw",
    "dev_encoded": _encoded("dev"),
    "later_encoded": _encoded("later"),
    "negatives": """
        SELECT customer_id, code AS category_code FROM (
            SELECT i.customer_id, l.code, c.holders, row_number() OVER (
                       PARTITION BY l.code ORDER BY md5(concat_ws('|', '42', i.customer_id, l.code)), i.customer_id)
                       AS place,
                   count(*) OVER (PARTITION BY l.code) AS others
            FROM (SELECT DISTINCT customer_id FROM dev_positives) i
            CROSS JOIN label_codes l
            JOIN (SELECT category_code, count(*) AS holders FROM dev_positives GROUP BY category_code) c
              ON c.category_code = l.code
            WHERE l.in_target = 1
              AND NOT EXISTS (SELECT 1 FROM dev_positives p
                              WHERE p.customer_id = i.customer_id AND p.category_code = l.code))
        WHERE place <= least(others, 2 * holders)""",
    "pairs": """
        SELECT customer_id, category_code AS target_category, 1 AS target FROM dev_positives
        UNION ALL SELECT customer_id, category_code, 0 FROM negatives""",
    "later_pairs": "SELECT customer_id, category_code AS target_category, 1 AS target FROM later_positives",
    "sides": """
        SELECT customer_id, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42', customer_id)), customer_id)
                                      <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
        FROM dev_ids""",
    "train": """
        SELECT customer_id, category_code AS target_category FROM dev_positives JOIN sides USING (customer_id)
        WHERE split = 'train'""",
    "test": """
        SELECT customer_id, category_code AS target_category, category
        FROM dev_positives JOIN sides USING (customer_id) JOIN label_codes ON code = category_code
        WHERE split = 'test'""",
    "shares": "SELECT target_category, count(*) / (SELECT count(*) FROM train) AS share FROM train GROUP BY ALL",
    "test_grid": """
        SELECT customer_id, code AS target_category
        FROM (SELECT DISTINCT customer_id FROM test) CROSS JOIN label_codes WHERE in_target = 1""",
    "scored": _scored("test_grid", "dev_history"),
    "best": _best("scored"),
    "picks": """
        SELECT customer_id, category AS pred_item, score FROM best JOIN label_codes ON code = target_category""",
    "evaluated": _hits("picks", "test"),
    "test_allowed": """
        SELECT * FROM test WHERE category IN ('Brand#4', 'Brand#7', 'Brand#11', 'Brand#15', 'Brand#19', 'Brand#21',
                                              'Brand#25')""",
    "old_picks": """
        SELECT customer_id, category AS old_item FROM (
            SELECT customer_id, category, row_number() OVER (
                       PARTITION BY customer_id ORDER BY count(*) DESC, category) AS place
            FROM dev_history GROUP BY customer_id, category) WHERE place = 1""",
    "old_evaluated": _hits("""(SELECT customer_id, old_item AS pred_item
                              FROM (SELECT DISTINCT customer_id FROM test) LEFT JOIN old_picks USING (customer_id))""",
                           "test"),
    "later_grid": "SELECT customer_id, code AS target_category FROM later_ids CROSS JOIN label_codes WHERE in_target = 1",
    "later_scored": _scored("later_grid", "later_history"),
    "later_best": _best("later_scored"),
    "later_truth": "SELECT DISTINCT customer_id, category FROM later_target",
    "later_picks": """
        SELECT customer_id, category AS pred_item FROM later_best JOIN label_codes ON code = target_category""",
    "later_evaluated": _hits("later_picks", "later_truth"),
    "second_scored": f"SELECT * FROM scored WHERE target_category > {FIRST_STAGE_CODES}",
    "second_best": _best(f"(SELECT * FROM second_scored WHERE score >= {SECOND_STAGE_MINIMUM})"),
    "hybrid_picks": f"""
        SELECT p.customer_id,
               CASE WHEN f.code <= {FIRST_STAGE_CODES} THEN p.pred_item ELSE coalesce(s.category, 'z') END AS pred_item,
               CASE WHEN f.code <= {FIRST_STAGE_CODES} THEN 'first' ELSE 'second' END AS source
        FROM picks p JOIN label_codes f ON f.category = p.pred_item
        LEFT JOIN (SELECT customer_id, category FROM second_best JOIN label_codes ON code = target_category) s
          USING (customer_id)""",
    "hybrid": _hits("hybrid_picks", "test"),
    "class_best": _best("second_scored"),
    "class_pairs": f"""
        SELECT t.customer_id, t.target_category AS true_code, b.target_category AS pred_code
        FROM test t JOIN class_best b USING (customer_id) WHERE t.target_category > {FIRST_STAGE_CODES}""",
    "test_pairs": """
        SELECT customer_id, target_category, target FROM pairs JOIN sides USING (customer_id) WHERE split = 'test'""",
    "scored_pairs": _scored("test_pairs", "dev_history"),
    "eligible": """
        SELECT customer_id, product_code, product_class, category, contract_date
        FROM contracts JOIN customer ON c_custkey = customer_id
        WHERE contract_date >= DATE '1999-09-01' AND o_orderpriority <> '5-LOW'
          AND (l_returnflag = 'N' OR o_orderstatus IN ('F')) AND l_linestatus = 'O' AND c_mktsegment = 'BUILDING'""",
    "purchases": """
        SELECT DISTINCT strftime(contract_date, '%Y%m') AS month, customer_id, product_class, category FROM eligible""",
    "cells": """
        SELECT month, category, count(DISTINCT customer_id) AS customers
        FROM purchases WHERE product_class NOT IN ('PROMO') GROUP BY month, category""",
    "cohort_cells": """
        SELECT month, category, count(DISTINCT customer_id) AS customers
        FROM purchases WHERE product_class NOT IN ('PROMO')
          AND customer_id IN (SELECT customer_id FROM dev_customers WHERE balance IS NOT NULL)
        GROUP BY month, category""",
    "coverage_pairs": """
        SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS product_code, CAST(l_suppkey AS VARCHAR) AS coverage_code
        FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag <> 'R'""",
    "population": """
        SELECT *, row_number() OVER (ORDER BY customer_id, identity_code) AS id FROM dev_customers
        WHERE customer_id IN (SELECT customer_id FROM dev_target_all)""",
}

# All customers of the later month, as a saved model encodes them: without history no products and a null summary.
_CTES |= {
    "serve_history": "SELECT * FROM later_history_all",
    **{f"serve_{part}": _CTES[f"later_{part}"].replace("later_", "serve_") for part in ("newest", "last", "summary")},
    "serve_raw": f"""
        SELECT * REPLACE ({", ".join(f"coalesce({c}, 0) AS {c}" for c in _PRODUCTS)})
        FROM later_customers LEFT JOIN serve_last USING (customer_id) LEFT JOIN serve_summary USING (customer_id)""",
    "serve_encoded": _encoded("serve"),
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in _CTES.items())


def _add(name: str, sql: str) -> None:
    ORACLE[name] = f"{_WITH}\n{sql}"


_DAY = "strftime(contract_date, '%Y-%m-%d') AS contract_date"


def _step(split: str, step: str, source: str) -> str:
    return f"""SELECT '{split}' AS split, '{step}' AS step, count(*) AS row_count,
                      strftime(min(contract_date), '%Y-%m-%d') AS first_date,
                      strftime(max(contract_date), '%Y-%m-%d') AS last_date FROM ({source})"""


_ROW = "customer_id, product_code, product_class, category, contract_date"
_add("temporal_split_counts", " UNION ALL ".join([
    _step("history", "loaded", "SELECT * FROM dev_history_raw"),
    _step("target", "loaded", "SELECT * FROM dev_target_all"),
    _step("target", "class_excluded", "SELECT * FROM dev_target_all WHERE product_class <> 'PROMO'"),
    _step("target", "category_excluded", """SELECT * FROM dev_target_all WHERE product_class <> 'PROMO'
                                            AND category NOT IN ('Brand#1', 'Brand#2')"""),
    _step("target", "variant_excluded", "SELECT * FROM dev_target_raw"),
    _step("target", "rows_distinct", f"SELECT DISTINCT {_ROW} FROM dev_target_raw"),
    _step("history", "projected_distinct", "SELECT DISTINCT customer_id, category, contract_date FROM dev_history_raw"),
    _step("target", "projected_distinct", "SELECT DISTINCT customer_id, category, contract_date FROM dev_target_raw")]))
_add("population_audit", " UNION ALL ".join(
    f"SELECT '{name}' AS split, 'population_{step}' AS step, count(*) AS row_count FROM {source} WHERE {where}"
    for name, source in (("customers", "dev_customers"), ("history", "(SELECT DISTINCT customer_id, category, contract_date FROM dev_history_raw)"),
                         ("target", "(SELECT DISTINCT customer_id, category, contract_date FROM dev_target_raw)"))
    for step, where in (("before", "true"), ("after", "customer_id IN (SELECT customer_id FROM dev_ids)"))))
_add("category_codes", "SELECT category, code, in_target FROM label_codes")
_add("encoded_history", f"SELECT customer_id, category, category_code, {_DAY} FROM dev_history_all")
_add("encoded_target", f"SELECT customer_id, category, category_code, {_DAY} FROM later_target_coded")
_add("target_window_contracts", f"""SELECT {_ROW.replace('contract_date', '')} {_DAY} FROM contracts
    WHERE contract_date >= DATE '2001-01-01' AND contract_date < DATE '2001-07-01'""")
_add("common_population", "SELECT customer_id FROM dev_ids")
_add("last_n_products", "SELECT * FROM dev_last")
_add("history_summary", "SELECT * FROM dev_summary")
_add("held_flags", "SELECT customer_id, " + ", ".join(
    f"max(CASE WHEN category_code = {c} THEN 1 ELSE 0 END) AS pre_yn_{c}" for c in _ALL_CODES)
    + " FROM dev_history GROUP BY customer_id")
_add("months_since_by_category", "SELECT customer_id, " + ", ".join(
    f"coalesce(min(CASE WHEN category_code = {c} THEN {_elapsed('contract_date', '1999-12-01')} END), -1) AS pre_m_{c}"
    for c in _ALL_CODES) + " FROM dev_history GROUP BY customer_id")
_add("null_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM dev_customers"
    for c in ["customer_id", "identity_code", "ref_month", "segment", "nation", "balance"]))
_add("categorical_encoder", """
    SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS INTEGER) AS code
    FROM (SELECT 'segment' AS feature, segment AS value FROM dev_customers WHERE segment IS NOT NULL
          UNION SELECT 'nation', nation FROM dev_customers WHERE nation IS NOT NULL
          UNION SELECT 'segment', 'unknown' UNION SELECT 'nation', 'unknown')""")
_add("numeric_encoder", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, low_{c} AS low, high_{c} AS high FROM ranges" for c in _NUMERIC))
_add("encoded_features", "SELECT * FROM later_encoded")
_add("vocabulary_sizes", """
    SELECT 'segment' AS feature, CAST(max(segment) + 1 AS BIGINT) AS size FROM dev_encoded
    UNION ALL SELECT 'nation', CAST(max(nation) + 1 AS BIGINT) FROM dev_encoded
    UNION ALL SELECT 'target_category', count(*) + 1 FROM label_codes WHERE in_target = 1""" + "".join(
    f" UNION ALL SELECT '{c}', count(*) + 1 FROM label_codes" for c in _PRODUCTS))
_add("negative_samples", "SELECT * FROM negatives")
_add("target_pairs", "SELECT * FROM pairs")
_add("target_summary", """
    SELECT count(*) AS num_of_rows, CAST(sum(target) AS BIGINT) AS num_of_target,
           round(sum(target) / count(*) * 100, 1) AS percent_of_target,
           count(DISTINCT CASE WHEN target = 1 THEN customer_id END) AS num_of_target_ids,
           round(count(DISTINCT CASE WHEN target = 1 THEN customer_id END) / (SELECT count(*) FROM dev_ids) * 100, 1)
               AS percent_of_target_ids
    FROM pairs""")
_add("category_mix", """
    SELECT category_code, count(*) AS count,
           round(count(*) / (SELECT count(*) FROM dev_positives) * 100, 2) AS percent
    FROM dev_positives GROUP BY category_code""")
_add("modelling_table", "SELECT * FROM dev_encoded LEFT JOIN pairs USING (customer_id)")
_add("modelling_table_later", "SELECT * FROM later_encoded LEFT JOIN later_pairs USING (customer_id)")
_add("group_split", "SELECT * FROM sides")
_add("candidate_scores", "SELECT customer_id, target_category, has_item, score FROM scored")
_RANKED = """
    SELECT customer_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, target_category)
           AS INTEGER) AS result_rank, category AS prdct, score
    FROM scored JOIN label_codes ON code = target_category"""
_add("ranked_candidates", _RANKED)
_add("recommend_one", f"""
    SELECT * FROM ({_RANKED}) WHERE customer_id = (
        SELECT customer_id FROM scored ORDER BY md5(concat_ws('|', '42', customer_id)), customer_id LIMIT 1)""")
_add("best_candidate", "SELECT customer_id, pred_item, score FROM picks")
_add("true_items", "SELECT customer_id, string_agg(category, ',' ORDER BY category) AS true_item FROM test GROUP BY ALL")
_add("hit_accuracy", _accuracy("evaluated"))
_add("hit_accuracy_later", _accuracy("later_evaluated"))
_add("baseline_accuracy", _accuracy("old_evaluated"))
_add("baseline_accuracy_allowed", _accuracy("(" + _hits("""
    (SELECT customer_id, old_item AS pred_item FROM (SELECT DISTINCT customer_id FROM test_allowed)
     LEFT JOIN old_picks USING (customer_id))""", "test_allowed") + ")"))
_add("accuracy_by_category", _report("evaluated", "test"))
_add("baseline_accuracy_by_category", _report("old_evaluated", "test"))
_add("hybrid_accuracy_by_category", _report("hybrid", "test"))
_add("train_test_mix", """
    SELECT category, train_count, round(train_count / (SELECT count(*) FROM train) * 100, 1) AS train_pct,
           test_count, round(test_count / (SELECT count(*) FROM test) * 100, 1) AS test_pct
    FROM (SELECT category, count(*) AS train_count FROM train JOIN label_codes ON code = target_category GROUP BY ALL)
    LEFT JOIN (SELECT category, count(*) AS test_count FROM test GROUP BY ALL) USING (category)""")
_LABELS = ", ".join(f"max(CASE WHEN target_category = {c} THEN 1 ELSE 0 END) AS label_{c}" for c in _TARGET_CODES)
_add("multi_label_matrix", f"SELECT customer_id, {_LABELS} FROM test GROUP BY customer_id")
_add("multi_label_report", """
    SELECT code AS label, coalesce(true_count, 0) AS true_count, coalesce(pred_count, 0) AS pred_count,
           coalesce(pred_true, 0) AS pred_true,
           round(coalesce(pred_true, 0) / nullif(coalesce(pred_count, 0), 0) * 100, 1) AS accuracy_pred,
           round(coalesce(pred_true, 0) / nullif(coalesce(true_count, 0), 0) * 100, 1) AS accuracy_true
    FROM label_codes
    LEFT JOIN (SELECT target_category AS code, count(*) AS true_count FROM test GROUP BY ALL) USING (code)
    LEFT JOIN (SELECT target_category AS code, count(*) AS pred_count FROM best GROUP BY ALL) USING (code)
    LEFT JOIN (SELECT target_category AS code, count(*) AS pred_true
               FROM test JOIN best USING (customer_id, target_category) GROUP BY ALL) USING (code)
    WHERE in_target = 1""")
_add("exact_match_accuracy", """
    SELECT count(*) AS customers, CAST(sum(exact) AS BIGINT) AS exact, round(sum(exact) / count(*), 4) AS accuracy
    FROM (SELECT t.customer_id, CASE WHEN count(*) = 1 AND max(t.target_category) = max(b.target_category)
                                     THEN 1 ELSE 0 END AS exact
          FROM test t JOIN best b USING (customer_id) GROUP BY t.customer_id)""")
_add("multi_label_input", "SELECT * FROM later_encoded JOIN (SELECT customer_id, "
     + _LABELS + " FROM later_pairs GROUP BY customer_id) USING (customer_id)")
_add("multi_class_input", f"""
    SELECT e.*, target_category - {FIRST_STAGE_CODES + 1} AS label
    FROM dev_encoded e JOIN pairs USING (customer_id)
    WHERE target = 1 AND target_category > {FIRST_STAGE_CODES}""")
_add("multi_class_report", """
    SELECT true_code AS class, true_count, coalesce(pred_count, 0) AS pred_count, coalesce(pred_true, 0) AS pred_true,
           round(coalesce(pred_true, 0) / nullif(coalesce(pred_count, 0), 0) * 100, 1) AS accuracy_pred,
           round(coalesce(pred_true, 0) / true_count * 100, 1) AS accuracy_true
    FROM (SELECT true_code, count(*) AS true_count FROM class_pairs GROUP BY ALL)
    LEFT JOIN (SELECT pred_code AS true_code, count(*) AS pred_count,
                      count(*) FILTER (WHERE true_code = pred_code) AS pred_true
               FROM class_pairs GROUP BY pred_code) USING (true_code)""")
_add("hybrid_recommend", "SELECT customer_id, pred_item, source, hit FROM hybrid")
_add("log_loss", """
    SELECT round(avg(CASE WHEN target = 1 THEN -ln(p) ELSE -ln(1 - p) END), 6) AS log_loss, count(*) AS pairs
    FROM (SELECT target, greatest(least(score, CAST(1 AS DOUBLE) - CAST(1e-15 AS DOUBLE)), CAST(1e-15 AS DOUBLE)) AS p
          FROM scored_pairs)""")
_add("auc", """
    SELECT round((sum(CASE WHEN target = 1 THEN place END) - any_value(pos) * (any_value(pos) + 1) / 2)
                 / (CAST(any_value(pos) AS DOUBLE) * any_value(neg)), 6) AS auc,
           any_value(pos) AS positives, any_value(neg) AS negatives
    FROM (SELECT target, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS place,
                 count(*) FILTER (WHERE target = 1) OVER () AS pos, count(*) FILTER (WHERE target = 0) OVER () AS neg
          FROM scored_pairs)""")
_add("eligible_contracts", f"SELECT customer_id, product_code, product_class, category, {_DAY} FROM eligible")
_add("monthly_purchases", "SELECT * FROM purchases")
_add("monthly_product_names", f"""
    SELECT DISTINCT strftime(contract_date, '%Y%m') AS month, customer_id, p_name AS product_name, product_class, category
    FROM eligible JOIN part ON p_partkey = product_code
    WHERE strftime(contract_date, '%Y%m') = '{TREND_MONTHS[-1]}'""")
_add("monthly_customers", "SELECT * FROM cells")


def _trend(cells: str) -> str:
    shown = ", ".join(f"max(CASE WHEN month = '{m}' THEN share END) AS m{m}" for m in TREND_MONTHS)
    return f"""SELECT category, {shown} FROM (
        SELECT month, category, round(customers / sum(customers) OVER (PARTITION BY month) * 100 * 5) / 5 AS share
        FROM {cells} WHERE month <= '{TREND_MONTHS[-1]}') GROUP BY category"""


_add("monthly_trend", _trend("cells"))
_add("monthly_trend_cohort", _trend("cohort_cells"))
_add("product_table", """SELECT p_partkey AS product_code, p_name AS product_name, p_type AS class_code,
                         p_brand AS category_code, p_size AS size_code FROM part""")
_add("main_coverages", """SELECT s_suppkey AS coverage_code, s_name AS coverage_name, s_nationkey AS group_code
                          FROM supplier WHERE s_nationkey <> 1""")
_add("risk_rates", """SELECT DISTINCT l_returnflag AS risk_code, l_linestatus AS risk_type, l_tax AS rate,
                      l_linenumber AS occurrence FROM lineitem""")
_add("product_coverage_pairs", "SELECT * FROM coverage_pairs")
_add("coverage_risk_pairs", "SELECT DISTINCT l_suppkey AS coverage_code, l_returnflag AS risk_code FROM lineitem")
_add("product_reference", """
    SELECT product_code, p_name AS product_name, p_type AS class_code, coverage_code, s_name AS coverage_name
    FROM coverage_pairs JOIN part ON CAST(p_partkey AS VARCHAR) = product_code
    JOIN supplier ON CAST(s_suppkey AS VARCHAR) = coverage_code WHERE s_nationkey <> 1""")
_add("classify_products", """
    SELECT p_partkey AS product_code,
           CASE WHEN p_type IN ('PROMO', 'ECONOMY') AND p_brand IN ('Brand#4', 'Brand#5', 'Brand#6') THEN 'small promo'
                WHEN p_type IN ('STANDARD', 'MEDIUM') AND p_brand <> 'Brand#7' AND p_size NOT IN (1, 2, 3) THEN 'standard'
                WHEN p_type = 'LARGE' THEN 'large' ELSE 'other' END AS "group"
    FROM part""")
_add("base_population", "SELECT id, ref_month, segment, nation, balance FROM population")
_add("identity_map", "SELECT id, customer_id, identity_code FROM population")
_add("training_extract", f"""
    SELECT id, product_code, product_class, category, {_DAY}
    FROM population LEFT JOIN (SELECT * FROM contracts WHERE contract_date < DATE '2000-07-01') USING (customer_id)""")
_add("serving_input", f"""
    SELECT id, category, product_code, product_class, {_DAY}, CAST(place AS INTEGER) AS order_column FROM (
        SELECT i.id, c.*, row_number() OVER (PARTITION BY i.id ORDER BY contract_date DESC, category, product_code,
                                             product_class) AS place
        FROM (SELECT c_custkey AS customer_id, row_number() OVER (ORDER BY c_custkey) AS id FROM customer) i
        JOIN contracts c USING (customer_id) WHERE contract_date < DATE '2001-07-01') WHERE place <= 5""")
_add("baseline_picks", """
    SELECT id, category AS old_item FROM (
        SELECT customer_id, category, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category) AS place
        FROM dev_history_raw GROUP BY customer_id, category)
    JOIN population USING (customer_id) WHERE place = 1""")


def _audit(name: str, source: str, keys: str) -> str:
    return f"""SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
                      CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
               FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})"""


_add("duplicate_audit", " UNION ALL ".join([
    _audit("contracts", "contracts", _ROW),
    _audit("items", "contracts", "customer_id, category, contract_date"),
    _audit("buyers", "contracts", "customer_id"),
    _audit("customers", "dev_customers", "customer_id")]))


def _check(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS check_name, CAST(({sql}) AS BIGINT) AS violations"


_add("dataset_checks", " UNION ALL ".join([
    _check("history before target", """SELECT CASE WHEN (SELECT max(contract_date) FROM dev_history)
           < (SELECT min(contract_date) FROM dev_target) THEN 0 ELSE 1 END"""),
    _check("target spans six periods", """SELECT CASE WHEN datediff('day', min(contract_date), max(contract_date)) // 30
           = 6 THEN 0 ELSE 1 END FROM dev_target"""),
    _check("one reference month", "SELECT abs(count(DISTINCT ref_month) - 1) FROM dev_raw"),
    _check("customers unique", "SELECT count(*) FROM (SELECT customer_id FROM dev_raw GROUP BY ALL HAVING count(*) > 1)"),
    _check("features keep rows", "SELECT abs((SELECT count(*) FROM dev_encoded) - (SELECT count(*) FROM dev_ids))"),
    _check("no nulls in encoded features", """SELECT count(*) FROM dev_encoded WHERE segment IS NULL OR nation IS NULL
           OR pre_contract_count IS NULL OR pre_contract_month_min IS NULL OR pre_contract_month_max IS NULL"""),
    _check("no null balance", "SELECT count(*) FROM dev_encoded WHERE balance IS NULL"),
    _check("a newest product for everyone", "SELECT count(*) FROM dev_encoded WHERE product_1 = 0"),
    _check("pairs unique", """SELECT count(*) FROM (SELECT customer_id, target_category FROM pairs
           GROUP BY ALL HAVING count(*) > 1)"""),
    _check("train and test disjoint", """SELECT count(*) FROM (SELECT customer_id FROM sides WHERE split = 'train'
           INTERSECT SELECT customer_id FROM sides WHERE split = 'test')"""),
    _check("candidates complete", """SELECT abs((SELECT count(*) FROM test_grid) - (SELECT count(*) FROM sides
           WHERE split = 'test') * (SELECT count(*) FROM label_codes WHERE in_target = 1))"""),
    _check("split covers all", "SELECT abs((SELECT count(*) FROM sides) - (SELECT count(*) FROM dev_ids))"),
    _check("classes contiguous", f"""SELECT CASE WHEN min(c) = 0 AND max(c) = count(DISTINCT c) - 1 THEN 0 ELSE 1 END
           FROM (SELECT target_category - {FIRST_STAGE_CODES + 1} AS c FROM pairs
                 WHERE target = 1 AND target_category > {FIRST_STAGE_CODES})"""),
    _check("target has all customers", """SELECT count(*) FROM (SELECT customer_id FROM dev_ids
           EXCEPT SELECT customer_id FROM dev_target)"""),
    _check("history has all customers", """SELECT count(*) FROM (SELECT customer_id FROM dev_ids
           EXCEPT SELECT customer_id FROM dev_history)"""),
    _check("every label occurs", """SELECT count(*) FROM label_codes WHERE in_target = 1
           AND code NOT IN (SELECT category_code FROM dev_positives)""")]))


def _uniform(salt: str, seed: int = 42) -> str:
    text = f"md5(concat_ws('|', '{seed}', '{salt}', row_id))"
    return f"((CAST('0x' || substr({text}, 1, 12) AS BIGINT) + 0.5) / CAST(281474976710656 AS DOUBLE))"


def _normal(column: str, seed: int) -> str:
    return f"(sqrt(-2.0 * ln({_uniform(column + '/r', seed)})) * cos(2.0 * pi() * {_uniform(column + '/a', seed)}))"


def _drawn(source: str, column: str, seed: int, per_customer: int) -> str:
    """(row_id, customer_id, column) drawn by the column's shares in `source`."""
    return f"""
        SELECT row_id, customer_id, {column}
        FROM (SELECT row_id, row_id % (SELECT count(*) FROM dev_ids) + 1 AS customer_id,
                     CAST(floor({_uniform(column, seed)} * (SELECT sum(units) FROM {source}_{column}_units)) AS BIGINT) AS unit
              FROM (SELECT unnest(range({per_customer} * (SELECT count(*) FROM dev_ids))) AS row_id))
        JOIN (SELECT {column}, CAST(sum(units) OVER (ORDER BY {column}) - units AS BIGINT) AS low,
                     CAST(sum(units) OVER (ORDER BY {column}) AS BIGINT) AS high
              FROM {source}_{column}_units) ON unit >= low AND unit < high"""


def _units(source: str, column: str) -> str:
    return f"""
        SELECT {column}, CAST(round(count(*) / (SELECT count({column}) FROM {source}) * 1e15) AS BIGINT) AS units
        FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


def _dated(source: str, seed: int, per_customer: int) -> str:
    return f"""
        SELECT d.*, DATE '1970-01-01' + CAST(floor((m.mean + m.std * {_normal('contract_date', seed)}) / 86400) AS INTEGER) AS day
        FROM ({_drawn(source, 'category', seed, per_customer)}) d
        CROSS JOIN (SELECT avg(epoch(contract_date)) AS mean, stddev_samp(epoch(contract_date)) AS std FROM {source}) m"""


_SAMPLE = {
    **{f"{source}_{column}_units": _units(source, column) for source, column in (
        ("dev_target", "category"), ("dev_history", "category"), ("dev_raw", "ref_month"), ("dev_raw", "segment"), ("dev_raw", "nation"))},
    "target_draws": _dated("dev_target", 42, 5),
    "history_draws": _dated("dev_history", 43, 10),
    "sample_target": f"""
        SELECT customer_id, category, arg_min(contract_date, row_id) AS contract_date FROM (
            SELECT customer_id, row_id, category,
                   CASE WHEN day < DATE '1999-12-01' THEN DATE '1999-12-01' + CAST(floor({_uniform('redraw')} * 184.0) AS INTEGER)
                        ELSE day END AS contract_date FROM target_draws)
        GROUP BY customer_id, category""",
    "sample_history": f"""
        SELECT customer_id, category,
               CASE WHEN day > DATE '1999-12-01' THEN DATE '1999-12-01' - CAST(floor({_uniform('redraw', 43)} * least(
                        (SELECT greatest(count(*) FILTER (WHERE day > DATE '1999-12-01'), 1) FROM history_draws), 36525)) AS INTEGER)
                    ELSE day END AS contract_date FROM history_draws""",
    "sample_customers": f"""
        SELECT customer_id, ref_month, segment, nation, m.mean + m.std * {_normal('balance', 44)} AS balance
        FROM ({_drawn('dev_raw', 'ref_month', 44, 1)}) JOIN ({_drawn('dev_raw', 'segment', 44, 1)}) USING (row_id, customer_id)
        JOIN ({_drawn('dev_raw', 'nation', 44, 1)}) USING (row_id, customer_id)
        CROSS JOIN (SELECT avg(balance) AS mean, stddev_samp(balance) AS std FROM dev_raw) m""",
}


def _add_sample(name: str, sql: str) -> None:
    _add(name, "")
    ORACLE[name] = ORACLE[name].rstrip() + "".join(f",\n{table} AS ({body})" for table, body in _SAMPLE.items()) + "\n" + sql


_add_sample("synthesize", f"""
    SELECT customer_id, category, code AS category_code, {_DAY} FROM sample_target JOIN label_codes USING (category)""")
_add_sample("synthesize_history", f"""
    SELECT customer_id, category, code AS category_code, {_DAY} FROM sample_history JOIN label_codes USING (category)""")
_add_sample("synthesize_customers", "SELECT * REPLACE (round(balance, 2) AS balance) FROM sample_customers")
_add_sample("synthesize_checks", " UNION ALL ".join([
    _check("customers unique", "SELECT count(*) FROM (SELECT customer_id FROM sample_customers GROUP BY ALL HAVING count(*) > 1)"),
    *[_check(f"{name} has all customers", f"""SELECT count(*) FROM (SELECT DISTINCT customer_id FROM sample_{name}) t
        FULL JOIN sample_customers c USING (customer_id) WHERE t.customer_id IS NULL OR c.customer_id IS NULL""") for name in ("target", "history")],
    _check("history up to target", """SELECT CASE WHEN (SELECT max(contract_date) FROM sample_history)
           <= (SELECT min(contract_date) FROM sample_target) THEN 0 ELSE 1 END"""),
    _check("every label occurs", """SELECT count(*) FROM label_codes WHERE in_target = 1
           AND category NOT IN (SELECT category FROM sample_target)""")]))


def _shares(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS column_name, 'share' AS kind, CAST({column} AS VARCHAR) AS value,
                      round(count(*) / sum(count(*)) OVER (), 9) AS share, CAST(NULL AS DOUBLE) AS mean,
                      CAST(NULL AS DOUBLE) AS std
               FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


def _moments(column: str, value: str, source: str) -> str:
    return f"""SELECT '{column}', 'normal', NULL, NULL, round(avg({value}), 3), round(stddev_samp({value}), 3)
               FROM {source}"""


_add("column_profile", " UNION ALL ".join([
    _shares("ref_month", "dev_customers"), _shares("segment", "dev_customers"), _shares("nation", "dev_customers"),
    _moments("balance", "balance", "dev_customers"), _shares("o_orderstatus", "orders"),
    _shares("o_orderpriority", "orders"), _moments("o_totalprice", "o_totalprice", "orders"),
    _moments("contract_date", "epoch(o_orderdate)", "orders")]))

_add("merged_profile", " UNION ALL ".join([
    _shares("o_orderstatus", "orders"), _shares("o_orderpriority", "orders"), _moments("o_totalprice", "o_totalprice", "orders"),
    _moments("contract_date", "epoch(o_orderdate)", "orders")]))
_add("saved_model_scores", """
    SELECT customer_id, code AS target_category, true AS equal
    FROM later_customers CROSS JOIN label_codes WHERE in_target = 1""")
_add("saved_model_features", "SELECT * FROM serve_encoded")
_add("saved_model_second_stage", "SELECT DISTINCT customer_id, true AS equal FROM sides WHERE split = 'test'")
