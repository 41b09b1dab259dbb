"""The same results in plain SQL over the same tables, for DuckDB."""

from __future__ import annotations

from devfold.models.fit import ALL_INPUTS, input_names
from devfold.registry.queries import DIGITS, GRID, GROUPS, SPACE, VOCABULARY

DAY_SECONDS = "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)


def _quoted(names: list[str]) -> str:
    return ", ".join(f"('{n}')" for n in names)


def _wide(key: str, value: str, columns: dict[int, str], source: str) -> str:
    """One row per device of ``source`` with a summed column per key."""
    cells = ", ".join(f'CAST(coalesce("{k}", 0) AS BIGINT) AS "{c}"' for k, c in columns.items())
    keys = ", ".join(map(str, columns))
    tall = f"SELECT device_id, {key}, {value} FROM {source}"
    return f"SELECT device_id, {cells} FROM (PIVOT ({tall}) ON {key} IN ({keys}) USING sum({value}) GROUP BY device_id)"


LABEL_COLUMNS = {i + 1: c for i, c in enumerate(SPACE.label_names)}
SLICE_COLUMNS = {i + 1: c for i, c in enumerate(SPACE.slice_names)}
CLUSTER_COLUMNS = dict(enumerate(SPACE.cluster_names))

# Named parts; a query names the ones it needs, in any order.
PARTS = {
    "devices": """
        SELECT c_custkey AS device_id,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CAST(18 + c_custkey % 50 AS INT) AS age, c_mktsegment AS grp
        FROM customer""",
    "train": "SELECT * FROM devices WHERE device_id % 10 < 8",
    "test": "SELECT device_id FROM devices WHERE device_id % 10 >= 8",
    "phones": """
        SELECT c_custkey AS device_id, r_name AS phone_brand, n_name AS device_model
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "attrs": """
        SELECT device_id, gender, age, phone_brand, device_model, grp
        FROM train JOIN phones USING (device_id)""",
    "base": """
        SELECT device_id, CAST(CASE WHEN gender = 'F' THEN 0 ELSE 1 END AS INT) AS gender, age,
               phone_brand AS brand, device_model AS model, grp
        FROM attrs
        UNION ALL SELECT device_id, NULL, NULL, phone_brand, device_model, NULL
        FROM test JOIN phones USING (device_id)""",
    "everyone": """
        SELECT * FROM attrs
        UNION ALL SELECT device_id, NULL, NULL, phone_brand, device_model, NULL
        FROM test JOIN phones USING (device_id)""",
    "label_apps": """
        SELECT DISTINCT o_custkey AS device_id, p_size AS label_id, l_partkey AS app_id
        FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "label_counts": """
        SELECT device_id, label_id, count(app_id) AS ile FROM label_apps
        GROUP BY device_id, label_id""",
    "label_wide": _wide("label_id", "ile", LABEL_COLUMNS, "label_counts"),
    "activity": """
        SELECT event_id, user_id AS device_id, ts,
               CASE WHEN k % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(k - 50 AS DOUBLE) END AS longitude,
               CASE WHEN k % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS latitude
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "sliced": f"""
        SELECT event_id, device_id, CAST({DAY_SECONDS} // 600 + 1 AS INT) AS slice,
               longitude, latitude
        FROM activity""",
    "slice_counts": """
        SELECT device_id, slice, count(*) AS c FROM sliced GROUP BY device_id, slice""",
    "time_wide": _wide("slice", "c", SLICE_COLUMNS, "slice_counts"),
    "allev": "SELECT device_id, count(*) AS allev FROM activity GROUP BY device_id",
    "nolat": """
        SELECT device_id, count(*) AS nolat FROM activity
        WHERE latitude = 0 AND longitude = 0 GROUP BY device_id""",
    "centres": f"""
        SELECT CAST(cluster AS INT) AS cluster, CAST(cx AS DOUBLE) AS cx, CAST(cy AS DOUBLE) AS cy
        FROM (VALUES {_values([(i, x, y) for i, (x, y) in enumerate(GRID)])}) AS v(cluster, cx, cy)""",
    "assigned": """
        SELECT event_id, device_id, slice, longitude, latitude, cluster FROM (
            SELECT s.*, cluster, row_number() OVER (
                PARTITION BY event_id
                ORDER BY (longitude - cx) * (longitude - cx) + (latitude - cy) * (latitude - cy),
                         cluster) AS place
            FROM sliced s, centres)
        WHERE place = 1""",
    "cluster_counts": """
        SELECT device_id, cluster, count(*) AS n FROM assigned GROUP BY device_id, cluster""",
    "cluster_wide": _wide("cluster", "n", CLUSTER_COLUMNS, "cluster_counts"),
    "label_long": """
        SELECT device_id, CAST(label_id AS VARCHAR) AS feature, CAST(ile AS DOUBLE) AS value
        FROM label_counts""",
    "long": """
        SELECT * FROM label_long
        UNION ALL SELECT device_id, 't' || slice, CAST(c AS DOUBLE) FROM slice_counts
        UNION ALL SELECT device_id, 'allev', CAST(allev AS DOUBLE) FROM allev
        UNION ALL SELECT device_id, 'nolat', CAST(nolat AS DOUBLE) FROM nolat
        UNION ALL SELECT device_id, 'c' || cluster, CAST(n AS DOUBLE) FROM cluster_counts""",
    "factors": f"""
        SELECT feature, CASE WHEN m > 3 THEN m / CAST(3 AS DOUBLE) ELSE m END AS factor
        FROM (SELECT feature, greatest(coalesce(max(value), CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) AS m
              FROM (VALUES {_quoted(SPACE.names)}) AS v(feature)
              LEFT JOIN (SELECT * FROM long WHERE device_id IN (SELECT device_id FROM devices))
              USING (feature)
              GROUP BY feature)""",
    "factor_row": "SELECT "
    + ", ".join(f'"{c}" AS "f_{c}"' for c in SPACE.names)
    + " FROM (PIVOT (SELECT feature, factor FROM factors) ON feature IN ("
    + ", ".join(f"'{c}'" for c in SPACE.names)
    + ") USING max(factor))",
    "label_stats": """
        SELECT feature, CASE WHEN count(*) < n THEN CAST(0 AS DOUBLE) ELSE min(value) END AS min,
               max(value) AS max, sum(value) / n AS mean
        FROM label_long, (SELECT count(DISTINCT device_id) AS n FROM label_long)
        GROUP BY feature, n""",
    "constants": f"""
        SELECT feature, coalesce(min, CAST(0 AS DOUBLE)) AS value
        FROM (VALUES {_quoted(VOCABULARY)}) AS v(feature) LEFT JOIN label_stats USING (feature)
        WHERE coalesce(min, 0) = coalesce(max, 0)""",
    "totals": """
        SELECT device_id, allev, nolat FROM devices
        LEFT JOIN allev USING (device_id) LEFT JOIN nolat USING (device_id)""",
    "shares": "SELECT phone_brand, "
    + ", ".join(
        f"CAST(count(*) FILTER (WHERE grp = '{g}') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS {g}"
        for g in GROUPS
    )
    + " FROM attrs GROUP BY phone_brand",
    "overall": "SELECT "
    + ", ".join(
        f"CAST(count(*) FILTER (WHERE grp = '{g}') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS o_{g}"
        for g in GROUPS
    )
    + " FROM attrs",
    "class_moments": """
        SELECT grp, feature, n, sum(value) / n AS mu, sum(value * value) / n AS sq
        FROM label_long JOIN train USING (device_id)
        JOIN (SELECT grp, count(*) AS n FROM train GROUP BY grp) USING (grp)
        GROUP BY grp, feature, n""",
    # Gaussian naive Bayes on the label counts, written out.
    "nb_cells": f"""
        SELECT s.grp, v.feature, s.n, coalesce(mu, 0) AS mu, coalesce(sq, 0) AS sq
        FROM (SELECT grp, count(*) AS n FROM train GROUP BY grp) s
        CROSS JOIN (VALUES {_quoted(SPACE.label_names)}) AS v(feature)
        LEFT JOIN class_moments m ON m.grp = s.grp AND m.feature = v.feature""",
    "nb_boost": """
        SELECT max(s2 / t - (s1 / t) * (s1 / t)) * 1e-9 AS eps
        FROM (SELECT feature, sum(n * mu) AS s1, sum(n * sq) AS s2, sum(n) AS t
              FROM nb_cells GROUP BY feature)""",
    "nb_fitted": """
        SELECT grp, feature, n, mu, sq - mu * mu + eps AS var FROM nb_cells, nb_boost""",
    "nb_inputs": f"""
        SELECT t.device_id, v.feature, coalesce(value, 0) AS x
        FROM test t CROSS JOIN (VALUES {_quoted(SPACE.label_names)}) AS v(feature)
        LEFT JOIN label_long l ON l.device_id = t.device_id AND l.feature = v.feature""",
    "nb_scored": """
        SELECT device_id, grp, ln(CAST(n AS DOUBLE))
               + sum(-(x - mu) * (x - mu) / (2 * var) - 0.5 * ln(var)) AS ll
        FROM nb_inputs JOIN nb_fitted USING (feature)
        GROUP BY device_id, grp, n""",
    "nb_soft": """
        SELECT device_id, grp, exp(ll - max(ll) OVER (PARTITION BY device_id)) AS e
        FROM nb_scored""",
    "nb_normed": """
        SELECT device_id, grp, e / sum(e) OVER (PARTITION BY device_id) AS p FROM nb_soft""",
    "nb_wide": "SELECT device_id, "
    + ", ".join(f"round(max(p) FILTER (WHERE grp = '{g}'), {DIGITS}) AS {g}" for g in GROUPS)
    + " FROM nb_normed GROUP BY device_id",
}


def _sql(body: str) -> str:
    """``body`` with the parts it mentions, directly or through other parts."""
    words = lambda text: set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
    needed: set[str] = set()
    todo = [body]
    while todo:
        for name in words(todo.pop()) & PARTS.keys() - needed:
            needed.add(name)
            todo.append(PARTS[name])
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed)
    return f"WITH {parts}\n{body}" if parts else body


def _scaled(column: str) -> str:
    return f'round(CAST("{column}" AS DOUBLE) / nullif("f_{column}", 0), {DIGITS}) AS "{column}"'


def oracles() -> dict[str, str]:
    md5_bucket = (
        "CAST('0x' || substr(md5('1:' || CAST(device_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000"
    )
    body = {
        "time_slice": "SELECT event_id, slice FROM sliced",
        "events_with_slice": "SELECT * FROM sliced",
        "csv_round_trip": "SELECT * FROM sliced",
        "drop_empty_rows": """
            SELECT event_id,
                   CASE WHEN event_id % 7 > 1 THEN device_id END AS device_id,
                   CASE WHEN event_id % 7 > 1 THEN longitude END AS longitude,
                   CASE WHEN event_id % 7 > 1 THEN latitude END AS latitude
            FROM activity WHERE event_id % 7 <> 0""",
        "encode_gender": """
            SELECT device_id, CAST(CASE WHEN gender = 'F' THEN 0 ELSE 1 END AS INT) AS gender_code
            FROM devices""",
        "to_int": """
            SELECT app_id, label_text, TRY_CAST(label_text AS INT) AS label_id
            FROM (SELECT p_partkey AS app_id,
                         CASE WHEN p_partkey % 7 = 0 THEN p_type
                              ELSE CAST(p_size AS VARCHAR) END AS label_text
                  FROM part)""",
        "events_without_location": """
            SELECT event_id, device_id FROM activity WHERE latitude = 0 AND longitude = 0""",
        "replace_columns": """
            SELECT device_id, gender, CAST(age * 12 AS INT) AS age, phone_brand AS brand,
                   device_model, grp
            FROM attrs""",
        "index_categories": """
            SELECT device_id, phone_brand, device_model, grp,
                   CAST(dense_rank() OVER (ORDER BY phone_brand) - 1 AS DOUBLE) AS phone_brand_idx,
                   CAST(dense_rank() OVER (ORDER BY device_model) - 1 AS DOUBLE) AS device_model_idx,
                   CAST(dense_rank() OVER (ORDER BY grp) - 1 AS DOUBLE) AS grp_idx
            FROM attrs""",
        "device_slice_counts": "SELECT device_id, slice, c FROM slice_counts",
        "ordered_slice_counts": """
            SELECT device_id, slice, c FROM slice_counts ORDER BY device_id, slice""",
        "time_histogram": "SELECT * FROM time_wide",
        "device_label_apps": "SELECT * FROM label_apps",
        "device_label_counts": "SELECT * FROM label_counts",
        "device_attributes": "SELECT * FROM attrs",
        "device_label_long": "SELECT * FROM everyone LEFT JOIN label_counts USING (device_id)",
        "device_label_strings": """
            SELECT device_id, string_agg(CAST(label_id AS VARCHAR), ',' ORDER BY label_id) AS labels,
                   string_agg(CAST(ile AS VARCHAR), ',' ORDER BY label_id) AS iles
            FROM label_counts GROUP BY device_id""",
        "parse_label_list": "SELECT * FROM label_counts",
        "label_matrix": "SELECT * FROM base LEFT JOIN label_wide USING (device_id)",
        "label_categories": """
            SELECT p_partkey AS app_id, p_size AS label_id, category
            FROM part LEFT JOIN (SELECT p_size, min(p_type) AS category FROM part GROUP BY p_size)
            USING (p_size)""",
        "label_category_counts": """
            SELECT category, count(*) AS n_labels, CAST(sum(n) AS BIGINT) AS n_apps
            FROM (SELECT p_size AS label_id, min(p_type) AS category, count(*) AS n
                  FROM part GROUP BY p_size)
            GROUP BY category""",
        "unlabelled_profile": """
            SELECT device_id, CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS INT) AS age,
                   phone_brand, device_model, CAST(NULL AS VARCHAR) AS grp
            FROM test JOIN phones USING (device_id)""",
        "full_profile": """
            SELECT * FROM base LEFT JOIN label_wide USING (device_id)
            JOIN time_wide USING (device_id)""",
        "empty_profile": """
            SELECT * FROM base WHERE device_id NOT IN (SELECT device_id FROM activity)""",
        "all_profile": """
            SELECT * FROM base LEFT JOIN label_wide USING (device_id)
            LEFT JOIN time_wide USING (device_id) LEFT JOIN allev USING (device_id)
            LEFT JOIN nolat USING (device_id) LEFT JOIN cluster_wide USING (device_id)""",
        "all_devices": """
            SELECT * FROM train
            UNION SELECT device_id, CAST(NULL AS VARCHAR), CAST(NULL AS INT), CAST(NULL AS VARCHAR)
            FROM test""",
        "devices_without_events": """
            SELECT device_id FROM devices EXCEPT SELECT device_id FROM activity""",
        "distinct_devices": "SELECT DISTINCT device_id FROM activity",
        "reconcile_counts": """
            SELECT 'in' AS side, count(*) AS n_rows, count(DISTINCT device_id) AS n_devices
            FROM slice_counts
            UNION ALL SELECT 'out', count(*), count(DISTINCT device_id)
            FROM (SELECT DISTINCT device_id FROM activity)""",
        "peek": """
            SELECT * FROM attrs ORDER BY phone_brand, device_model, device_id LIMIT 20""",
        "events_per_device": "SELECT * FROM allev",
        "nolocation_per_device": "SELECT * FROM nolat",
        "inferred_csv": "SELECT * FROM allev",
        "assign_clusters": "SELECT event_id, device_id, cluster FROM assigned",
        "device_cluster_counts": "SELECT * FROM cluster_counts",
        "cluster_histogram": "SELECT * FROM cluster_wide",
        "activity_rollup": """
            SELECT device_id, slice, cluster, (latitude = 0 AND longitude = 0) AS nowhere,
                   count(*) AS n
            FROM assigned GROUP BY ALL""",
        "first_event": """
            SELECT device_id, min(event_id) AS event FROM activity GROUP BY device_id""",
        "leak_devices": """
            SELECT device_id, phone_brand, device_model, gender, age, grp
            FROM (SELECT * FROM train UNION SELECT device_id, NULL, NULL, NULL FROM test)
            JOIN phones USING (device_id)""",
        "leak_table": """
            SELECT device_id, phone_brand, device_model, gender, age, grp, event
            FROM (SELECT * FROM train UNION SELECT device_id, NULL, NULL, NULL FROM test)
            JOIN phones USING (device_id)
            LEFT JOIN (SELECT device_id, min(event_id) AS event FROM activity GROUP BY device_id)
            USING (device_id)
            ORDER BY phone_brand, device_model, device_id""",
        "leak_positions": """
            SELECT device_id, phone_brand, device_model, gender, age, grp, event,
                   row_number() OVER (ORDER BY phone_brand NULLS FIRST, device_model NULLS FIRST, device_id NULLS FIRST) AS position
            FROM (SELECT * FROM train UNION SELECT device_id, NULL, NULL, NULL FROM test)
            JOIN phones USING (device_id)
            LEFT JOIN (SELECT device_id, min(event_id) AS event FROM activity GROUP BY device_id)
            USING (device_id)""",
        "level_codes": """
            SELECT CAST(device_id AS VARCHAR) AS level,
                   CAST(row_number() OVER (ORDER BY CAST(device_id AS VARCHAR)) - 1 AS DOUBLE) AS code
            FROM devices""",
        "furthest_check": """
            SELECT least(20, count(DISTINCT (longitude, latitude))) AS n_starts, TRUE AS covered FROM activity""",
        "fit_inputs": """
            SELECT feature FROM label_long JOIN train USING (device_id) GROUP BY feature
            HAVING min(value) <> max(value)
                OR count(*) < (SELECT count(DISTINCT device_id) FROM label_long JOIN train USING (device_id))""",
        "feature_stats": f"SELECT feature, min, max, round(mean, {DIGITS}) AS mean FROM label_stats",
        "constant_features": "SELECT * FROM constants",
        "drop_constant": """
            SELECT * FROM label_long WHERE feature NOT IN (SELECT feature FROM constants)""",
        "scale_factors": f"SELECT feature, round(factor, {DIGITS}) AS factor FROM factors",
        "scaled_features": f"""
            SELECT device_id, feature, round(CASE WHEN factor IS NULL THEN value
                   ELSE value / nullif(factor, 0) END, {DIGITS}) AS value
            FROM long LEFT JOIN factors USING (feature)""",
        "scaled_profile": f"""
            SELECT device_id, gender, age, brand, model, grp,
                   {", ".join(_scaled(c) for c in SPACE.names)}
            FROM base LEFT JOIN label_wide USING (device_id)
            LEFT JOIN time_wide USING (device_id) LEFT JOIN allev USING (device_id)
            LEFT JOIN nolat USING (device_id) LEFT JOIN cluster_wide USING (device_id),
            factor_row""",
        "impute_mean": f"""
            SELECT device_id,
                   round(coalesce(CAST(allev AS DOUBLE), avg(allev) OVER ()), {DIGITS}) AS allev,
                   round(coalesce(CAST(nolat AS DOUBLE), avg(nolat) OVER ()), {DIGITS}) AS nolat
            FROM totals""",
        "standardized": f"""
            SELECT device_id,
                   round((a - avg(a) OVER ()) / stddev_samp(a) OVER (), {DIGITS}) AS allev,
                   round((b - avg(b) OVER ()) / stddev_samp(b) OVER (), {DIGITS}) AS nolat
            FROM (SELECT device_id, CAST(coalesce(allev, 0) AS DOUBLE) AS a,
                         CAST(coalesce(nolat, 0) AS DOUBLE) AS b
                  FROM totals)""",
        "materialized_split": f"SELECT * FROM devices WHERE {md5_bucket} < 9000",
        "hash_split": f"""
            SELECT device_id, CASE WHEN {md5_bucket} < 9000 THEN 'train' ELSE 'valid' END AS part
            FROM devices""",
        "nb_class_stats": f"""
            SELECT grp, feature, n, round(m1, {DIGITS}) AS mean, round(m2 - m1 * m1, {DIGITS}) AS variance
            FROM (SELECT c.grp, c.feature, c.n,
                         c.mu + (c.n - have) * coalesce(mid, 0) / c.n AS m1,
                         c.sq + (c.n - have) * coalesce(mid, 0) * coalesce(mid, 0) / c.n AS m2
                  FROM nb_cells c
                  JOIN (SELECT grp, count(*) FILTER (WHERE device_id IN (SELECT device_id FROM label_counts)) AS have
                        FROM train GROUP BY grp) h USING (grp)
                  LEFT JOIN (SELECT feature, sum(value) / (SELECT count(*) FROM train
                                 WHERE device_id IN (SELECT device_id FROM label_counts)) AS mid
                             FROM label_long JOIN train USING (device_id) GROUP BY feature) o USING (feature))""",
        "outside_vocabulary": f"""
            SELECT 'labels' AS block, count(DISTINCT label_id) AS n_keys, count(*) AS n_rows,
                   CAST(coalesce(sum(ile), 0) AS BIGINT) AS total
            FROM label_counts WHERE label_id NOT BETWEEN 1 AND {SPACE.labels}
            UNION ALL SELECT 'first 20 labels', count(DISTINCT label_id), count(*),
                   CAST(coalesce(sum(ile), 0) AS BIGINT)
            FROM label_counts WHERE label_id NOT BETWEEN 1 AND 20
            UNION ALL SELECT 'time', count(DISTINCT slice), count(*), CAST(coalesce(sum(c), 0) AS BIGINT)
            FROM slice_counts WHERE slice NOT BETWEEN 1 AND {SPACE.slices}""",
        "kmeans_check": """
            SELECT count(*) AS n_events, CAST(0 AS BIGINT) AS n_wrong, TRUE AS within_k
            FROM activity WHERE longitude IS NOT NULL AND latitude IS NOT NULL""",
        "importance_total": f"""
            SELECT CAST({len(input_names(ALL_INPUTS, SPACE))} AS BIGINT) AS n, CAST(1 AS DOUBLE) AS total""",
        "grid_settings": """
            SELECT CAST(t AS INT) AS trees, CAST(d AS INT) AS depth, TRUE AS scored
            FROM (VALUES (5, 3), (5, 5), (10, 3), (10, 5)) AS v(t, d)""",
        **{
            f"{name}_totals": "SELECT device_id, CAST(1 AS DOUBLE) AS total FROM test JOIN phones USING (device_id)"
            for name in ("nb", "forest", "mlp", "stacked", "submission", "network")
        },
        "full_totals": """
            SELECT device_id, CAST(1 AS DOUBLE) AS total FROM test JOIN phones USING (device_id)
            WHERE device_id IN (SELECT device_id FROM activity)""",
        "nb_label_scores": "SELECT * FROM nb_wide",
        "prior_submission": "SELECT device_id, "
        + ", ".join(f"round(coalesce({g}, o_{g}), {DIGITS}) AS {g}" for g in GROUPS)
        + " FROM test JOIN phones USING (device_id) LEFT JOIN shares USING (phone_brand), overall",
        "prior_logloss": f"""
            SELECT count(*) AS n, round(avg(-ln(greatest(p, 1e-15))), {DIGITS}) AS logloss,
                   round(avg((1 - p) * (1 - p)), {DIGITS}) AS mse,
                   round(1 - avg((1 - p) * (1 - p)) / var_samp(y), {DIGITS}) AS r2
            FROM (SELECT CASE {" ".join(f"WHEN grp = '{g}' THEN {g}" for g in GROUPS)} END AS p,
                         CASE {" ".join(f"WHEN grp = '{g}' THEN {i}" for i, g in enumerate(GROUPS))}
                         END AS y
                  FROM attrs JOIN shares USING (phone_brand))""",
    }
    texts = {name: _sql(text) for name, text in body.items()}
    return texts
