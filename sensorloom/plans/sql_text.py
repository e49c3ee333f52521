"""Shared pieces of the SQL twins: the roles as common table expressions."""

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

CTES = {
    "readings": "SELECT user_id, epoch_us(ts) AS r_us, value AS r_value, event_id AS r_id FROM events"
    " WHERE event_type IN ('view', 'click', 'signup')",
    "meals": "SELECT event_id AS meal_id, user_id, ts, epoch_us(ts) AS us, value AS carbs FROM events"
    " WHERE event_type = 'purchase'",
    "sport": "SELECT user_id, epoch_us(ts) AS r_us, nullif(value, 0.0) AS duration,"
    f" CASE {K} % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'moderate' ELSE 'high' END AS intensity_category"
    " FROM events WHERE event_type = 'error'",
    "answers": f"SELECT event_id AS id, user_id, ts, value AS score, CAST({K} AS DOUBLE) AS level,"
    f" {K} >= 50 AS flag FROM events WHERE event_type = 'signup'",
    "raw_items": "SELECT l_linenumber AS id, l_orderkey AS meal_id, l_partkey AS food_id,"
    " l_quantity * 50 AS amount, l_extendedprice / 20 AS calories, l_quantity * 4 AS protein,"
    " l_quantity * l_discount * 50 AS fat, l_extendedprice / 100 - 60 AS carbs FROM lineitem",
    "items": "SELECT id, meal_id, food_id, CASE WHEN amount <= 2000 THEN amount END AS amount,"
    " CASE WHEN calories BETWEEN 0 AND 3000 THEN calories END AS calories,"
    " CASE WHEN protein BETWEEN 0 AND 150 THEN protein END AS protein,"
    " CASE WHEN fat BETWEEN 0 AND 200 THEN fat END AS fat,"
    " CASE WHEN carbs BETWEEN 0 AND 500 THEN carbs END AS carbs FROM raw_items",
    "foods": "SELECT p_partkey AS food_id, p_name AS food_esp_name, CAST(p_size AS BIGINT) AS food_group_id,"
    " nullif(CAST(p_size AS DOUBLE), 10.0) AS fibre_gram_value, p_retailprice / 100 AS saturated_fatty_acid,"
    " p_size + 5.0 AS carbohydrate_gram_value, p_size / 2.0 AS fat_grams_value, p_size / 4.0 AS protein_gram_value,"
    " CASE WHEN p_type = 'ECONOMY' THEN 'Si' ELSE 'No' END AS atri_ultraprocessed,"
    " CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Si' ELSE 'No' END AS atri_high_glycemic_index,"
    " CASE WHEN p_type = 'LARGE' THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS portion FROM part",
}
CTES["nutr"] = (
    "SELECT meal_id, coalesce(sum(calories), 0) AS total_calories, coalesce(sum(protein), 0) AS total_protein,"
    " coalesce(sum(fat), 0) AS total_fat, coalesce(sum(carbs), 0) AS total_carbs, count(id) AS n_items,"
    " bool_or(calories IS NULL) AS has_nan_calories, bool_or(protein IS NULL) AS has_nan_macros,"
    " coalesce(sum(fibre_gram_value * amount / 100), 0) AS total_fibre,"
    " bool_or(fibre_gram_value IS NOT NULL) AS fibre_available,"
    " avg(CASE WHEN fibre_gram_value IS NULL THEN 0.0 ELSE 1.0 END) AS pct_items_with_fibre,"
    " count(*) FILTER (WHERE atri_ultraprocessed = 'Si') AS n_ultraprocessed,"
    " count(*) FILTER (WHERE atri_high_glycemic_index = 'Si') AS n_high_gi,"
    " avg(saturated_fatty_acid) AS avg_saturated_fat, count(DISTINCT food_group_id) AS n_food_groups"
    " FROM items LEFT JOIN foods USING (food_id) GROUP BY meal_id"
)
CTES["nutrition"] = (
    "SELECT *, total_carbs * 4 / nullif(total_calories, 0) * 100 AS pct_cal_carbs,"
    " total_protein * 4 / nullif(total_calories, 0) * 100 AS pct_cal_protein,"
    " total_fat * 9 / nullif(total_calories, 0) * 100 AS pct_cal_fat,"
    " total_fibre / nullif(total_carbs, 0) AS fibre_carb_ratio FROM nutr"
)
NEEDS = {"items": ("raw_items",), "nutr": ("items", "foods"), "nutrition": ("nutr",)}

HOUR = 3_600_000_000  # one window unit: a minute taken as an hour


def r(expr: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def ctes(*names: str, extra: dict[str, str] | None = None) -> str:
    """WITH clause of the named roles, then of `extra` in order."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        parts[name] = CTES[name]

    for n in names:
        add(n)
    parts.update(extra or {})
    return "WITH " + ", ".join(f"{n} AS ({body})" for n, body in parts.items()) + " "
