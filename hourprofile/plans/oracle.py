"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the query semantics, not from the Spark plans. The driver tables
are pre-registered as views (``events``, ``customer``, ...). Column names and
types match the Spark results.
"""

from __future__ import annotations

HOURS = range(24)
V = [f"v{h:02d}" for h in HOURS]
AVG = [f"avgvolume{h:02d}" for h in HOURS]

# Hour used by the scoring queries (the wall-clock hour is injected for tests).
SCORE_HOUR = 8


def _lst(items, sep=",\n  "):
    return sep.join(items)


# Wide observations, volumes kept numeric (BIGINT cents).
OBS_CTES = f"""ev AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS day,
  {_lst(f"CAST(SUM(CASE WHEN hour(ts) = {h} THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS {v}" for h, v in zip(HOURS, V))}
  FROM events GROUP BY user_id, event_type, CAST(ts AS DATE)
), obs AS (
  SELECT CAST(day AS VARCHAR) AS date,
    lpad(CAST(dayofmonth(day) AS VARCHAR), 2, '0') AS day_of_data,
    CAST(dayofweek(day) + 1 AS VARCHAR) AS day_of_week,
    event_type AS direction,
    lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state,
    c_mktsegment AS segment,
    lpad(CAST(month(day) AS VARCHAR), 2, '0') AS month_of_data,
    CAST(user_id AS VARCHAR) AS station_id,
    lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '_' || CAST(user_id AS VARCHAR) || '_' || event_type AS id,
    {", ".join(V)}
  FROM ev JOIN customer ON customer.c_custkey = ev.user_id
)"""

# Station rows, typed; keeps the raw nation for the coordinate filters.
STATION_CTES = f"""st_dir AS (
  SELECT * FROM customer, (SELECT DISTINCT event_type AS direction FROM events WHERE event_type IS NOT NULL)
), st_all AS (
  SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '_' || CAST(c_custkey AS VARCHAR) || '_' || direction AS id,
    c_name AS location, c_acctbal AS latitude, CAST(c_nationkey AS DOUBLE) * 0.5 AS longitude_w,
    c_nationkey, c_mktsegment AS type,
    CASE WHEN c_acctbal >= 5000 THEN 'Y' ELSE 'N' END AS highway
  FROM st_dir
), st_lanes AS (
  SELECT *, CAST(unnest(generate_series(1, 1 + c_nationkey % 2)) AS INTEGER) AS lanes FROM st_all
), st AS (
  SELECT id, location, latitude, longitude_w, lanes, type, highway FROM st_lanes
  WHERE latitude <> 0 AND longitude_w <> 0
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _profile_sql() -> str:
    avgs = _lst(f"avg(o.{v}) AS {a}" for v, a in zip(V, AVG))
    return with_ctes(OBS_CTES, STATION_CTES) + f"""SELECT s.id, s.location, s.latitude, s.longitude_w, s.lanes, s.type, s.highway,
  {avgs},
  0.0 - s.longitude_w AS longitude
FROM st s JOIN obs o ON s.id = o.id
GROUP BY s.id, s.location, s.latitude, s.longitude_w, s.lanes, s.type, s.highway"""


OBS_RECORD = ["date", "day_of_data", "day_of_week", "direction", "state", "segment",
              "month_of_data", "station_id", *V]
STATION_COLS = "id, location, latitude, longitude_w, lanes, type, highway"


def _key_sql(null_part: str) -> str:
    return with_ctes(OBS_CTES) + f"""SELECT date, station_id, direction,
  {null_part.format("state")} || '_' || {null_part.format("station_id")} || '_' || {null_part.format("NULLIF(direction, 'error')")} AS id
FROM obs"""


CATS = ["day_of_data", "day_of_week", "direction", "state", "segment", "month_of_data"]
NONNEG = " AND ".join(f"{v} >= 0" for v in V)


def mapping_ctes(where: str = "") -> str:
    """train -> levels -> mapping(field_pos, field, value, idx, offset)."""
    cond = f"({NONNEG})" + (f" AND ({where})" if where else "")
    lv = "\n  UNION ".join(
        f"SELECT DISTINCT CAST({i} AS INTEGER) AS field_pos, '{c}' AS field, {c} AS value FROM train WHERE {c} IS NOT NULL"
        for i, c in enumerate(CATS))
    return f"""train AS (SELECT * FROM obs WHERE {cond}),
lv AS (
  {lv}
), idx AS (
  SELECT field_pos, field, value,
    CAST(row_number() OVER (PARTITION BY field_pos ORDER BY value) - 1 AS INTEGER) AS idx
  FROM lv
), cnt AS (SELECT field_pos, count(*) AS n FROM idx GROUP BY field_pos
), offs AS (
  SELECT field_pos, CAST(coalesce(sum(n) OVER (ORDER BY field_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS "offset"
  FROM cnt
), mapping AS (SELECT i.field_pos, i.field, i.value, i.idx, o."offset" FROM idx i JOIN offs o USING (field_pos))"""


def encoded_sql(train_where: str = "", unseen: str = "fail") -> str:
    joins, cols = [], []
    for i, c in enumerate(CATS):
        joins.append(f"LEFT JOIN mapping m{i} ON m{i}.field_pos = {i} AND m{i}.value = t.{c}")
        cols.append(f'm{i}."offset" + m{i}.idx AS pos_{c}')
    src = "obs t" if train_where else "train t"
    where = f"WHERE {NONNEG}" if train_where else ""
    return with_ctes(OBS_CTES, mapping_ctes(train_where)) + f"""SELECT t.id, t.date, {", ".join(cols)}
FROM {src}
{chr(10).join(joins)}
{where}"""


def _profile_cte() -> str:
    avgs = _lst(f"avg(o.{v}) AS {a}" for v, a in zip(V, AVG))
    return f"""prof AS (
  SELECT s.id, s.location, s.latitude, s.longitude_w, s.lanes, s.type, s.highway,
  {avgs}
  FROM st s JOIN obs o ON s.id = o.id
  GROUP BY s.id, s.location, s.latitude, s.longitude_w, s.lanes, s.type, s.highway
)"""


def _logd(v: str) -> str:
    return f"ln(CAST({v} AS DOUBLE) + 0.01)"


def _features(hour: int):
    """Log expressions of the 23 features of ``hour`` (hours before, then after)."""
    return [_logd(V[j]) for j in HOURS if j != hour]


def _enc_cte() -> str:
    joins = "\n  ".join(f"LEFT JOIN mapping m{i} ON m{i}.field_pos = {i} AND m{i}.value = t.{c}"
                         for i, c in enumerate(CATS))
    ps = ", ".join(f'm{i}."offset" + m{i}.idx AS p{i}' for i in range(len(CATS)))
    return f"""enc AS (
  SELECT t.*, {ps}
  FROM train t
  {joins}
), kk AS (SELECT CAST(count(*) AS INTEGER) AS k FROM mapping)"""


def _gram_sql() -> str:
    ps = ", ".join(f"p{i}" for i in range(len(CATS)))
    fs = ", ".join(str(i) for i in range(len(CATS)))
    qs = ", ".join(f"CAST(round({_logd(v)}, 6) AS DECIMAL(12,6))" for v in V)
    hs = ", ".join(str(h) for h in HOURS)
    return with_ctes(OBS_CTES, mapping_ctes(), _enc_cte(), f"""up AS (
  SELECT id, date, unnest([{ps}]) AS p, unnest([{fs}]) AS f FROM enc
), uq AS (
  SELECT id, date, unnest([{qs}]) AS q, unnest([{hs}]) AS h FROM enc
), parts AS (
  SELECT least(a.p, b.p) AS i, greatest(a.p, b.p) AS j, CAST(count(*) AS DECIMAL(38,12)) AS s
  FROM up a JOIN up b ON a.id = b.id AND a.date = b.date AND a.f <= b.f GROUP BY 1, 2
  UNION ALL
  SELECT up.p AS i, (SELECT k FROM kk) + uq.h AS j, CAST(sum(uq.q) AS DECIMAL(38,12)) AS s
  FROM up JOIN uq ON up.id = uq.id AND up.date = uq.date GROUP BY up.p, uq.h
  UNION ALL
  SELECT p AS i, (SELECT k FROM kk) + 24 AS j, CAST(count(*) AS DECIMAL(38,12)) AS s FROM up GROUP BY p
  UNION ALL
  SELECT (SELECT k FROM kk) + a.h AS i, (SELECT k FROM kk) + b.h AS j, CAST(sum(a.q * b.q) AS DECIMAL(38,12)) AS s
  FROM uq a JOIN uq b ON a.id = b.id AND a.date = b.date AND a.h <= b.h GROUP BY a.h, b.h
  UNION ALL
  SELECT (SELECT k FROM kk) + h AS i, (SELECT k FROM kk) + 24 AS j, CAST(sum(q) AS DECIMAL(38,12)) AS s FROM uq GROUP BY h
  UNION ALL
  SELECT (SELECT k FROM kk) + 24 AS i, (SELECT k FROM kk) + 24 AS j, CAST(count(*) AS DECIMAL(38,12)) AS s FROM enc
)""") + "SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CAST(round(s, 6) AS DOUBLE) AS g FROM parts"


def _system_ctes() -> str:
    """gram -> one linear system per hour: ``a`` (rows of features and bias), ``b``
    (label column), ``c`` (label's sum of squares), ``n`` (rows)."""
    return f"""gram AS MATERIALIZED (
  SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CAST(round(s, 6) AS DOUBLE) AS g FROM parts
), side AS (SELECT CAST(unnest(range((SELECT k FROM kk) + 25)) AS INTEGER) AS i
), line AS MATERIALIZED (
  SELECT x.i, list(coalesce(u.g, v.g, CAST(0 AS DOUBLE)) ORDER BY y.i) AS r FROM side x CROSS JOIN side y
  LEFT JOIN gram u ON u.i = x.i AND u.j = y.i LEFT JOIN gram v ON v.i = y.i AND v.j = x.i GROUP BY x.i
), sys AS MATERIALIZED (
  SELECT CAST(h AS INTEGER) AS hour, (SELECT k FROM kk) + h AS lab,
    list(list_concat(r[1:(SELECT k FROM kk) + h], r[(SELECT k FROM kk) + h + 2:]) ORDER BY i) FILTER (i <> (SELECT k FROM kk) + h) AS a,
    list(r[(SELECT k FROM kk) + h + 1] ORDER BY i) FILTER (i <> (SELECT k FROM kk) + h) AS b,
    max(r[(SELECT k FROM kk) + h + 1]) FILTER (i = (SELECT k FROM kk) + h) AS c,
    max(r[(SELECT k FROM kk) + 25]) FILTER (i = (SELECT k FROM kk) + 24) AS n
  FROM line CROSS JOIN range(24) AS t(h) GROUP BY h
)"""


def _gram_ctes() -> str:
    """The WITH list of the Gram query, to go on from."""
    return _gram_sql().rpartition("SELECT CAST(i AS INTEGER)")[0].removeprefix("WITH ").rstrip()


def _fit_sql() -> str:
    """Gradient descent as a recursive query: weights 0, bias 1, step 0.01 / sqrt(i),
    at most 100 steps, stop on a relative change below 0.001 from the second on."""
    return "WITH RECURSIVE " + _gram_ctes() + ", " + _system_ctes() + """, gd AS (
  SELECT hour, 0 AS t, list_concat(list_transform(range(len(b) - 1), lambda i: CAST(0 AS DOUBLE)), [CAST(1 AS DOUBLE)]) AS w, false AS done FROM sys
  UNION ALL
  SELECT hour, t, w2, t >= 2 AND sqrt(list_sum(list_transform(list_zip(w, w2), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))
      < 0.001 * greatest(sqrt(list_dot_product(w2, w2)), 1)
  FROM (SELECT g.hour, g.t + 1 AS t, g.w, list_transform(list_zip(g.w, s.a, s.b),
      lambda z: z[1] - 0.01 / sqrt(CAST(g.t + 1 AS DOUBLE)) * ((list_dot_product(z[2], g.w) - z[3]) / s.n)) AS w2
    FROM gd g JOIN sys s ON s.hour = g.hour WHERE g.t < 100 AND NOT g.done)
), last AS (SELECT hour, max(t) AS iterations, arg_max(w, t) AS w FROM gd GROUP BY hour)
SELECT hour, CAST(iterations AS INTEGER) AS iterations, CAST(unnest(range(len(w))) AS INTEGER) AS feature,
  round(unnest(w), 6) + CAST(0 AS DOUBLE) AS weight
FROM last"""


def _rank_sql() -> str:
    """Elimination with diagonal pivots as a recursive query, then mean predictions by date."""
    feats = ", ".join(_logd(v) for v in V)
    ps = ", ".join(f"p{i}" for i in range(len(CATS)))
    return "WITH RECURSIVE " + _gram_ctes() + ", " + _system_ctes() + f""", el AS (
  SELECT hour, 0 AS t, list_concat(list_transform(list_zip(a, b), lambda z: list_concat(z[1], [z[2]])), [list_concat(b, [c])]) AS m,
    list_transform(a, lambda r, i: r[i]) AS scale, CAST([] AS BIGINT[]) AS used, CAST(0 AS BIGINT) AS p
  FROM sys
  UNION ALL
  SELECT hour, t + 1, CASE WHEN p = 0 THEN m ELSE list_transform(m, lambda r, i: CASE WHEN i = p THEN list_transform(m[p], lambda x: x / m[p][p])
      ELSE list_transform(list_zip(r, m[p]), lambda z: z[1] - r[p] * (z[2] / m[p][p])) END) END, scale,
    CASE WHEN p = 0 THEN used ELSE list_append(used, p) END, p
  FROM (SELECT hour, t, m, scale, used, coalesce(list_extract(list_sort(list_transform(list_filter(range(1, len(scale) + 1),
        lambda i: NOT list_contains(used, i) AND scale[i] > 0 AND m[i][i] / scale[i] > 1e-9),
        lambda i: {{'v': -m[i][i] / scale[i], 'i': i}})), 1).i, 0) AS p
    FROM el WHERE t = 0 OR p > 0)
), done AS (
  SELECT hour, CAST(len(used) AS INTEGER) AS rank, m[len(m)][len(m)] AS rss,
    list_transform(range(1, len(scale) + 1), lambda i: CASE WHEN list_contains(used, i) THEN m[i][len(m)] ELSE 0 END) AS w
  FROM (SELECT hour, arg_max(m, t) AS m, arg_max(used, t) AS used, any_value(scale) AS scale FROM el GROUP BY hour)
), f AS (SELECT date, [{ps}] AS pos, [{feats}] AS x FROM enc)
SELECT hour, date, rank, round(rss, 3) AS rss,
  round(avg(w[len(w)] + list_sum(list_transform(pos, lambda q: w[q + 1]))
    + list_dot_product(w[len(w) - 23:len(w) - 1], list_concat(x[1:hour], x[hour + 2:]))), 6) AS predicted
FROM done CROSS JOIN f GROUP BY hour, date, rank, rss"""


def _predict_expr(hour: int) -> str:
    cat = "0.0"
    for i in range(len(CATS)):
        cat = f"({cat} + CAST((p{i} % 5) - 2 AS DOUBLE) / 64)"
    vol = "0.0"
    for m, x in enumerate(_features(hour)):
        vol = f"({vol} + {((m % 4) + 1) / 128.0!r} * {x})"
    return f"exp((CAST({hour / 8.0!r} AS DOUBLE) + {cat}) + {vol})"


def _level(v: str, h: str) -> str:
    return (f"CASE WHEN {h} IS NULL OR {v} IS NULL THEN NULL "
            f"WHEN CAST({v} AS DOUBLE) > {h} * CAST(2.0 AS DOUBLE) THEN 'High' "
            f"WHEN CAST({v} AS DOUBLE) < {h} * CAST(0.5 AS DOUBLE) THEN 'Low' ELSE 'Medium' END")


def _current(v: str) -> str:
    x = f"CAST({v} AS DOUBLE)"
    return (f"CAST(trunc(greatest({x} + {x} * CAST(0.5 AS DOUBLE) * CAST(1.764052345967664 AS DOUBLE), "
            f"CAST(0.0 AS DOUBLE))) AS INTEGER)")


MSG_KEY_SQL = "state || '_' || station_id || '_' || direction || '_' || date"


def _obj_json(cols) -> str:
    pairs = ", ".join(f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":' || to_json({c}) END""" for c in cols)
    return f"'{{' || concat_ws(',', {pairs}) || '}}'"


def _obs_strings() -> str:
    """Observation record with the volumes as text, as the raw record carries them."""
    vs = ", ".join(f"CAST({v} AS VARCHAR) AS {v}" for v in V)
    return f"""obs_s AS (
  SELECT date, day_of_data, day_of_week, direction, state, segment, month_of_data, station_id, {vs}
  FROM obs
)"""


RESULT = ["sid", "location", "latitude", "longitude", "direction", "lanes", "roadtype",
          "highway", "current", "historical", "predicted", "level"]


def _scored_ctes() -> str:
    h = SCORE_HOUR
    vh = f"CAST(e.{V[h]} AS BIGINT)"
    return f"""scored AS (
  SELECT e.date, e.id AS sid, p.location, p.latitude, p.longitude_w AS longitude, e.direction,
    p.lanes, e.segment AS roadtype, p.highway, {_current(vh)} AS current,
    p.{AVG[h]} AS historical, round({_predict_expr(h)}, 6) AS predicted,
    {_level(vh, "p." + AVG[h])} AS level
  FROM enc e JOIN prof p ON p.id = e.id
)"""


def _scored_base() -> str:
    return with_ctes(OBS_CTES, mapping_ctes(), _enc_cte(), STATION_CTES, _profile_cte(),
                     _scored_ctes())


def _fold_sql(policy: str) -> str:
    cols = ", ".join(f"f.{c}" for c in RESULT if c not in ("sid", "current"))
    if policy == "latest":
        return _scored_base() + f"""SELECT {", ".join(RESULT)} FROM (
  SELECT *, row_number() OVER (PARTITION BY sid ORDER BY date DESC, lanes DESC) AS rn FROM scored
) WHERE rn = 1"""
    return _scored_base() + f"""SELECT f.sid, {cols}, l.current FROM (
  SELECT *, row_number() OVER (PARTITION BY sid ORDER BY date, lanes) AS rn FROM scored
) f JOIN (
  SELECT sid, current, row_number() OVER (PARTITION BY sid ORDER BY date DESC, lanes DESC) AS rn FROM scored
) l ON f.sid = l.sid AND l.rn = 1
WHERE f.rn = 1"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["hourly_profile"] = _profile_sql()
    q["hourly_profile_eager"] = _profile_sql()
    q["hourly_profile_naive"] = _profile_sql()
    q["dense_index_keys"] = """SELECT l_returnflag, l_orderkey, count(*) AS lines,
  CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey) - 1 AS INTEGER) AS idx
FROM lineitem GROUP BY l_returnflag, l_orderkey"""
    kind = "CAST(station_id AS BIGINT) % 7"
    typed = f"CASE {kind} WHEN 0 THEN -1 WHEN 1 THEN 12 WHEN 6 THEN 3000000000 END"
    dirty = f"dirty AS (SELECT * REPLACE (CAST({typed} AS BIGINT) AS v08) FROM obs)"
    q["dirty_volumes_reason"] = with_ctes(OBS_CTES, dirty) + f"""SELECT id, date,
  CASE {kind} WHEN 0 THEN 'negative' WHEN 1 THEN 'ok' WHEN 2 THEN 'not_finite' WHEN 3 THEN 'not_finite'
    WHEN 6 THEN 'ok' ELSE 'missing' END AS reason, v08 AS volume
FROM dirty"""
    q["dirty_volumes_profile"] = _profile_sql().replace("JOIN obs o", "JOIN dirty o").replace(STATION_CTES, STATION_CTES + ",\n" + dirty)
    q["csv_header_roundtrip"] = with_ctes(OBS_CTES) + f"SELECT {', '.join(OBS_RECORD)} FROM obs"
    q["lines_split"] = q["csv_header_roundtrip"]
    q["composite_key"] = _key_sql("{}")
    q["composite_key_placeholder"] = _key_sql("coalesce({}, '*')")
    q["typed_projection"] = with_ctes(OBS_CTES, STATION_CTES) + f"SELECT {STATION_COLS} FROM st_lanes"
    q["filter_nonzero"] = with_ctes(OBS_CTES, STATION_CTES) + f"SELECT {STATION_COLS} FROM st"
    q["filter_nonzero_legacy"] = with_ctes(OBS_CTES, STATION_CTES) + (
        f"SELECT {STATION_COLS} FROM st_lanes WHERE trunc(latitude) <> 0 AND trunc(longitude_w) <> 0")
    neg = " OR ".join(f"{v} < 0" for v in V)
    miss = " OR ".join(f"{v} IS NULL" for v in V)
    q["filter_all_nonnegative"] = with_ctes(OBS_CTES) + f"""SELECT id, date,
  CASE WHEN {neg} THEN 'negative' WHEN {miss} THEN 'missing' ELSE 'ok' END AS reason,
  {", ".join(V)}
FROM obs"""
    vols = ", ".join(f"CAST(o.{v} AS BIGINT) AS volume{v[1:]}" for v in V)
    q["station_join"] = with_ctes(OBS_CTES, STATION_CTES) + f"""SELECT s.id, s.location, s.lanes, o.date, {vols}
FROM st s JOIN obs o ON s.id = o.id"""
    q["category_distinct"] = with_ctes(OBS_CTES, mapping_ctes()) + "SELECT field_pos, field, value FROM lv"
    q["category_mapping"] = with_ctes(OBS_CTES, mapping_ctes()) + "SELECT * FROM mapping"
    q["category_counts"] = with_ctes(OBS_CTES, mapping_ctes()) + """SELECT field_pos, field,
  CAST(count(*) AS INTEGER) AS n_levels, "offset",
  CAST(sum(count(*)) OVER () AS INTEGER) AS total
FROM mapping GROUP BY field_pos, field, "offset" """
    q["mapping_json_import"] = q["category_mapping"]
    q["encoded_positions"] = encoded_sql()
    q["encoded_unseen"] = encoded_sql(train_where="date < '2024-01-16'")
    h = SCORE_HOUR
    feats = ", ".join(f"round({x}, 6) AS f{m:02d}" for m, x in enumerate(_features(h)))
    q["log_features"] = with_ctes(OBS_CTES, f"train AS (SELECT * FROM obs WHERE {NONNEG})") + (
        f"SELECT id, date, round({_logd(V[h])}, 6) AS label, {feats} FROM train")
    q["gram_blocks"] = _gram_sql()
    q["predict_hour"] = with_ctes(OBS_CTES, mapping_ctes(), _enc_cte()) + (
        f"SELECT id, date, round({_predict_expr(h)}, 6) AS predicted FROM enc")
    q["fit_24_models"] = _fit_sql()
    q["fit_normal_rank"] = _rank_sql()
    ones = "\n  UNION ALL ".join(f"SELECT id, date, CAST(p{i} AS INTEGER) AS index, CAST(1 AS DOUBLE) AS value FROM enc" for i in range(len(CATS)))
    logs = "\n  UNION ALL ".join(f"SELECT id, date, CAST((SELECT k FROM kk) + {m} AS INTEGER) AS index, round({x}, 6) AS value FROM enc"
                                 for m, x in enumerate(_features(h)))
    q["sparse_features"] = with_ctes(OBS_CTES, mapping_ctes(), _enc_cte(), f"entries AS (\n  {ones}\n  UNION ALL {logs}\n)") + (
        "SELECT id, date, CAST((SELECT k FROM kk) + 23 AS INTEGER) AS size, index, value FROM entries")
    q["predict_all_hours"] = with_ctes(OBS_CTES, mapping_ctes(), _enc_cte()) + "\nUNION ALL\n".join(
        f"SELECT id, date, {x} AS hour, round({_predict_expr(x)}, 6) AS predicted FROM enc" for x in HOURS)
    hourly = "\n  UNION ALL\n  ".join(
        f"SELECT o.id AS sid, o.date, p.lanes, {x} AS hour, CAST(o.{V[x]} AS BIGINT) AS volume, p.{AVG[x]} AS historical "
        "FROM obs o JOIN prof p ON p.id = o.id" for x in HOURS)
    q["level_all_hours"] = (with_ctes(OBS_CTES, STATION_CTES, _profile_cte(), f"hourly AS (\n  {hourly}\n)")
                            + f"SELECT *, {_level('volume', 'historical')} AS level FROM hourly")
    vh = f"CAST(o.{V[h]} AS BIGINT)"
    q["at_hour"] = with_ctes(OBS_CTES) + f"SELECT o.id, o.date, {vh} AS volume FROM obs o"
    look = with_ctes(OBS_CTES, STATION_CTES, _profile_cte())
    q["profile_lookup"] = look + f"""SELECT o.id AS sid, o.date, p.lanes, {vh} AS volume, p.{AVG[h]} AS historical
FROM obs o JOIN prof p ON p.id = o.id"""
    q["level"] = look + f"""SELECT o.id AS sid, o.date, p.lanes, {vh} AS volume, p.{AVG[h]} AS historical,
  {_level(vh, "p." + AVG[h])} AS level
FROM obs o JOIN prof p ON p.id = o.id"""
    q["scaled_current"] = with_ctes(OBS_CTES) + f"SELECT o.id AS sid, o.date, {vh} AS volume, {_current(vh)} AS current FROM obs o"
    rec = ", ".join(OBS_RECORD)
    q["message_encode"] = with_ctes(OBS_CTES, _obs_strings()) + (
        f"SELECT {MSG_KEY_SQL} AS key, {_obj_json(OBS_RECORD)} AS value FROM obs_s")
    q["message_array"] = with_ctes(OBS_CTES, _obs_strings()) + (
        f"SELECT {MSG_KEY_SQL} AS key, CAST(to_json([{rec}]) AS VARCHAR) AS value FROM obs_s")
    q["message_decode"] = with_ctes(OBS_CTES, _obs_strings()) + (
        f"SELECT {MSG_KEY_SQL} AS key, {rec}, false AS corrupt FROM obs_s")
    q["message_decode_failfast"] = q["message_decode"]
    q["message_array_decode"] = q["message_decode"]
    q["message_array_quoted"] = q["message_decode"]
    q["message_unescaped"] = q["message_decode"]
    q["stream_ingest_time"] = with_ctes(OBS_CTES) + "SELECT date, station_id, direction, true AS stamped, true AS several_batches FROM obs"
    nulled = ", ".join(f"CASE WHEN direction = 'error' THEN NULL ELSE {c} END AS {c}" for c in OBS_RECORD)
    q["message_decode_bad"] = with_ctes(OBS_CTES, _obs_strings()) + (
        f"SELECT {MSG_KEY_SQL} AS key, {nulled}, direction = 'error' AS corrupt FROM obs_s")
    five = "CAST(station_id AS BIGINT) % 5"
    known = ", ".join(f"CASE WHEN {five} < 2 THEN {c} END AS {c}" for c in OBS_RECORD)
    q["message_mixed_decode"] = with_ctes(OBS_CTES, _obs_strings()) + f"SELECT {MSG_KEY_SQL} AS key, {known}, {five} >= 2 AS corrupt FROM obs_s"
    q["station_join_salted"] = q["station_join"]
    q["hourly_profile_salted"] = _profile_sql()
    q["stream_publish"] = q["message_decode"]
    q["stream_score"] = _scored_base() + f"SELECT date, {', '.join(RESULT)} FROM scored"
    q["stream_upsert"] = _fold_sql("first")
    q["stream_upsert_state"] = q["keyed_table_upsert"] = _fold_sql("first")
    best = """(SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '_' || CAST(c_custkey AS VARCHAR) || '_' || event_type
  FROM (SELECT c_custkey, c_nationkey FROM customer JOIN events ON user_id = c_custkey GROUP BY ALL ORDER BY count(*) DESC, c_custkey LIMIT 20) CROSS JOIN (SELECT DISTINCT event_type FROM events))"""
    q["keyed_table_lookup"] = _fold_sql("first") + f" AND f.sid IN {best}"
    early = _profile_cte().replace("prof AS", "prof_early AS").replace("ON s.id = o.id", "ON s.id = o.id AND o.date < '2024-01-16'")
    vh8 = f"CAST(o.{V[SCORE_HOUR]} AS BIGINT)"
    one = (f"SELECT o.id AS sid, o.date, p.lanes, {_current(vh8)} AS current, p.{AVG[SCORE_HOUR]} AS historical, "
           f"{_level(vh8, 'p.' + AVG[SCORE_HOUR])} AS level FROM obs o JOIN {{}} p ON p.id = o.id WHERE o.date {{}} '2024-01-16'")
    q["stream_profile_versions"] = (with_ctes(OBS_CTES, STATION_CTES, _profile_cte(), early)
                                    + one.format("prof_early", "<") + "\nUNION ALL\n" + one.format("prof", ">="))
    q["batch_metrics_observed"] = _scored_base() + "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(current) AS BIGINT) AS current FROM scored"
    q["upsert_latest"] = _fold_sql("latest")
    twice = "enc2 AS (SELECT * REPLACE (CAST(v08 AS BIGINT) + 100 AS v08), 0 AS copy FROM enc UNION ALL SELECT * REPLACE (CAST(v08 AS BIGINT) AS v08), 1 AS copy FROM enc)"
    seq = "2 * date_diff('day', CAST(e.date AS DATE), DATE '2024-01-01') + e.copy AS seq"
    q["stream_upsert_arrival"] = (_fold_sql("first").replace("scored AS (\n  SELECT e.date", f"{twice},\nscored AS (\n  SELECT {seq}, e.date")
                                  .replace("FROM enc e JOIN", "FROM enc2 e JOIN").replace("ORDER BY date, lanes", "ORDER BY seq, lanes")
                                  .replace("ORDER BY date DESC", "ORDER BY seq DESC"))
    station = "CAST(station_id AS BIGINT)"
    q["stream_quarantine"] = with_ctes(OBS_CTES, _obs_strings()) + f"""SELECT {MSG_KEY_SQL} AS key,
  CASE WHEN {station} % 11 = 0 THEN 'corrupt' WHEN {kind} = 0 THEN 'negative' WHEN {kind} IN (2, 3) THEN 'not_finite'
    WHEN {kind} IN (4, 5) THEN 'missing' ELSE 'unseen' END AS reason
FROM obs_s WHERE {station} % 11 = 0 OR {station} % 13 = 0 OR {kind} NOT IN (1, 6)"""
    q["batch_metrics"] = _scored_base() + "SELECT CAST(count(*) AS BIGINT) AS rows FROM scored"
    q["point_wkt"] = with_ctes(OBS_CTES, STATION_CTES, _profile_cte()) + """SELECT id, lanes,
  'POINT(' || CAST(0.0 - longitude_w AS VARCHAR) || ' ' || CAST(latitude AS VARCHAR) || ')' AS wkt,
  4326 AS srid
FROM prof"""
    def le(x):
        bits = f"lpad(lower(to_hex(CAST(CAST(CAST({x} AS DOUBLE) AS BIT) AS UBIGINT))), 16, '0')"
        return " || ".join(f"substr({bits}, {15 - 2 * k}, 2)" for k in range(8))
    q["point_wkb"] = with_ctes(OBS_CTES, STATION_CTES, _profile_cte()) + (
        f"SELECT id, lanes, '0101000020e6100000' || {le('0.0 - longitude_w')} || {le('latitude')} AS wkb FROM prof")
    return q
