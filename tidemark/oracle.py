"""SQL that states each registered query plainly, for checking against another engine.

Feature tables are spelled out the long way: every event joined to every split and
window that sees it, group aggregates joined back to the events, then one aggregation
per user. Nothing is shared with the build but the feature names.
"""

from __future__ import annotations

from tidemark.plans.spec import BASELINE_SPEC, KIND_KEYS, SPEC_1, SPEC_2, Feature, Spec
from tidemark.plans.splits import BASELINE, CALENDAR, LATEST, SET_1, SET_2, Catalogue
from tidemark.queries import LAST_WEEK, STUMP_FEATURES, WITHDRAWN, _weekday
from tidemark.sources.schema import LABELS

WATCH = """ev AS (
  SELECT user_id AS did, CAST(json_extract_string(props, '$.k') AS BIGINT) AS vid, value AS vts,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp" FROM events),
it AS (
  SELECT p_partkey AS vid, p_brand AS cid, CAST(p_size % 9 + 1 AS INTEGER) AS is_intact,
         1698796800 + p_size * 86400 AS online, p_name AS series_id,
         CAST(p_size AS DOUBLE) * 10 AS duration, p_type AS classify_id FROM part)"""

ORDERS = """ev AS (
  SELECT o_custkey AS did, l_partkey AS vid, l_quantity AS vts,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
it AS (
  SELECT p_partkey AS vid, p_brand AS cid, CAST(p_size % 9 + 1 AS INTEGER) AS is_intact,
         770428800 + p_size * 86400 AS online, p_name AS series_id,
         CAST(p_size AS DOUBLE) * 10 AS duration, p_type AS classify_id FROM part)"""

PREPARED = """lo AS (
  SELECT *, DATE '1970-01-01' + CAST(floor(("timestamp" + 28800) / 86400.0) AS INTEGER) AS date_day FROM ev),
pe AS (
  SELECT did, lo.vid, vts, "timestamp", date_day, CAST(isodow(date_day) AS INTEGER) AS date_weekday,
         cid, is_intact, classify_id, series_id, ("timestamp" - online) / 86400.0 AS u_date,
         vts / nullif(duration, 0) AS "vts/duration",
         vts / nullif(("timestamp" - online) / 86400.0, 0) AS "vts/u_date",
         vts / isodow(date_day) AS "vts/date_weekday"
  FROM lo LEFT JOIN it ON lo.vid = it.vid)"""


def base(source: str = WATCH) -> str:
    return f"WITH {source},\n{PREPARED}"


def quote(name: str) -> str:
    return f'"{name}"'


def shown(expr: str, name: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE) AS {quote(name)}"


def distinct(col: str) -> str:
    return f"count(DISTINCT {col}) + CASE WHEN count(*) > count({col}) THEN 1 ELSE 0 END"


def split_ctes(cat: Catalogue) -> str:
    """``sp``: label and history bounds; ``an``: the last event present in each history."""
    calendar = cat.mode == CALENDAR
    at, unit = ("date_day", 1) if calendar else ('"timestamp"', 86400)
    rows = ", ".join(f"('{name}', {off * unit})" for name, off in cat.offsets) or "('none', NULL)"
    gap = cat.gap * unit + (0 if calendar else 1)
    low = "DATE '0001-01-01'" if calendar else "-1000000000000"
    back = (lambda x: f"CAST({x} AS INTEGER)") if calendar else (lambda x: x)
    return f"""mx AS (SELECT max({at}) AS last FROM lo),
off(split, o) AS (VALUES {rows}),
sp AS (
  SELECT split, last - {back(f'(o + {cat.label_days * unit})')} AS l_first, last - {back('o')} AS l_last,
         last - {back(f'(o + {(cat.gap + cat.history_days) * unit})')} AS h_first,
         last - {back(f'(o + {gap})')} AS h_last FROM off, mx WHERE o IS NOT NULL
  UNION ALL SELECT 'test', NULL, NULL, {low}, last FROM mx),
an AS (SELECT split, h_first, max({at}) AS anchor FROM lo JOIN sp ON {at} BETWEEN h_first AND h_last GROUP BY ALL)"""


def labels_cte(cat: Catalogue) -> str:
    at = "date_day" if cat.mode == CALENDAR else '"timestamp"'
    return f"""la AS (
  SELECT split, did, count(DISTINCT date_day) AS active_days, count(*) AS watch_nums, sum(vts) AS watch_durations
  FROM lo JOIN sp ON {at} BETWEEN l_first AND l_last GROUP BY split, did)"""


def shown_labels() -> str:
    return "active_days, watch_nums, " + shown("watch_durations", "watch_durations")


def feature_expr(f: Feature) -> str:
    if f.kind == "stat":
        stat, key = f.arg
        x = quote(key)
        return {
            "w95": f"avg({x} * weight)", "mean": f"avg({x})", "std": f"stddev_samp({x})",
            "min": f"min({x})", "max": f"max({x})", "sum": f"sum({x})",
        }[stat]
    if f.kind == "kind_sum":
        return f"sum(vts) FILTER (WHERE is_intact = {f.arg[0]})"
    if f.kind == "kind_rows":
        return f"count(*) FILTER (WHERE is_intact = {f.arg[0]})"
    return {
        "rows": lambda: "count(*)",
        "ratio": lambda: f"({distinct('vid')}) / CAST(count(*) AS DOUBLE)",
        "span": lambda: '(max("timestamp") - min("timestamp")) / 3600.0',
        "distinct": lambda: distinct(f.arg[0]),
        "day_share": lambda: f"count(DISTINCT {f.arg[0]}) / CAST(days AS DOUBLE)",
        "favourite": lambda: f'max("{f.name}")',
    }[f.kind]()


def is_double(f: Feature) -> bool:
    """Counts, and bounds and sums of counts, are whole numbers."""
    if f.kind == "stat":
        return f.arg[0] in ("w95", "mean", "std") or not f.arg[1].endswith(("active_days", "watch_nums", "g_vid"))
    return f.kind in ("kind_sum", "ratio", "span", "day_share")


def feature_ctes(cat: Catalogue, spec: Spec) -> str:
    """``lf``: the long feature table, through one row per event, split and window."""
    at = "date_day" if cat.mode == CALENDAR else '"timestamp"'
    unit = 1 if cat.mode == CALENDAR else 86400
    age = f"anchor - {at}"
    inside = f"{age} < days" if cat.mode == CALENDAR else f"{age} <= days * {unit}"
    groups = ""
    joins = ""
    for keys, prefix in ((("vid",), "vid"), (("did", "cid"), "did_cid"), (("is_intact", "cid"), "is_intact_cid")):
        by = ", ".join(keys)
        groups += f"""
g_{prefix} AS (
  SELECT split, days, {by}, count(DISTINCT date_day) AS {prefix}_active_days, count(*) AS {prefix}_watch_nums,
         sum(vts) AS {prefix}_watch_durations FROM m GROUP BY split, days, {by}),"""
        on = " AND ".join(f"m.{k} = g_{prefix}.{k}" for k in ("split", "days", *keys))
        joins += f"\n  LEFT JOIN g_{prefix} ON {on}"
    likes = [f for f in spec.features if f.kind == "favourite"]
    for f in likes:
        groups += f"""
f_{f.arg[0]} AS (
  SELECT split, days, did, CAST({f.arg[0]} AS VARCHAR) AS "{f.name}",
         row_number() OVER (PARTITION BY split, days, did ORDER BY count(*) DESC, {f.arg[0]} DESC) AS rn
  FROM m WHERE {f.arg[0]} IS NOT NULL GROUP BY split, days, did, {f.arg[0]}),"""
        joins += (
            f"\n  LEFT JOIN f_{f.arg[0]} ON m.split = f_{f.arg[0]}.split AND m.days = f_{f.arg[0]}.days"
            f" AND m.did = f_{f.arg[0]}.did AND f_{f.arg[0]}.rn = 1"
        )
    columns = []
    for f in spec.features:
        value = feature_expr(f)
        value = f"CASE WHEN days >= {f.since} THEN {value} END" if f.since > 1 else value
        if f.kind != "favourite" and not is_double(f):
            value = f"CAST({value} AS BIGINT)"
        columns.append(f"{value} AS {quote(f.name)}")
    kinds = ", ".join(KIND_KEYS)
    weight = f"pow(0.95, CAST({age} + 1 AS DOUBLE))" if cat.mode == CALENDAR else "1.0"
    extra = "".join(f', f_{f.arg[0]}."{f.name}"' for f in likes)
    windows = ", ".join(f"({d})" for d in spec.windows)
    return f"""wd(days) AS (VALUES {windows}),
m AS (
  SELECT split, days, pe.*, {weight} AS weight
  FROM pe JOIN an ON {at} BETWEEN h_first AND anchor JOIN wd ON {inside}),{groups}
x AS (
  SELECT m.*, vid_active_days, vid_watch_nums, vid_watch_durations, vid_watch_nums AS g_vid,
         did_cid_active_days, did_cid_watch_nums, did_cid_watch_durations, {kinds}{extra}
  FROM m{joins}),
lf AS (
  SELECT split, CAST(days AS INTEGER) AS days, did, {", ".join(columns)}
  FROM x GROUP BY split, days, did)"""


def shown_feature(f: Feature, name: str, source: str = "") -> str:
    ref = source + quote(name)
    return shown(ref, name) if is_double(f) else f"{ref} AS {quote(name)}"


def long_sql(cat: Catalogue, spec: Spec, source: str = WATCH) -> str:
    picked = ", ".join(shown_feature(f, f.name) for f in spec.features)
    return f"{base(source)},\n{split_ctes(cat)},\n{feature_ctes(cat, spec)}\nSELECT split, days, did, {picked} FROM lf"


def wide_sql(cat: Catalogue, spec: Spec, windows, splits=None, tenure: bool = False) -> str:
    cells = [(f, d, f.wide(d)) for d in windows for f in spec.at(d)]
    pivot = ", ".join(f'max(CASE WHEN days = {d} THEN "{f.name}" END) AS {quote(n)}' for f, d, n in cells)
    out = ", ".join(shown_feature(f, n, "w.") for f, d, n in cells)
    test = "" if splits else " UNION ALL SELECT DISTINCT 'test', did, NULL, NULL, NULL FROM lo"
    where = f" WHERE r.split IN ({', '.join(repr(s) for s in splits)})" if splits else ""
    more = ", " + shown("t.activa_time", "activa_time") if tenure else ""
    join = " LEFT JOIN te t ON r.split = t.split AND r.did = t.did" if tenure else ""
    return f"""{base()},
{split_ctes(cat)},
{labels_cte(cat)},
{feature_ctes(cat, spec.pick(windows, lambda f: True))},
{TENURE}
rw AS (SELECT split, did, active_days, watch_nums, watch_durations FROM la{test}),
w AS (SELECT split, did, {pivot} FROM lf GROUP BY split, did)
SELECT r.split, r.did, {shown_labels()}, {out}{more} FROM rw r LEFT JOIN w ON r.split = w.split AND r.did = w.did{join}{where}"""


TENURE = """te AS (
  SELECT a.split, did, (max(anchor) - min("timestamp")) / 3600.0 AS activa_time
  FROM lo JOIN sp ON "timestamp" BETWEEN sp.h_first AND sp.h_last
  JOIN (SELECT split, max("timestamp") AS anchor FROM lo JOIN sp ON "timestamp" BETWEEN h_first AND h_last
        GROUP BY split) a ON a.split = sp.split
  GROUP BY a.split, did),"""


def last_week(name: str) -> str:
    keep = LAST_WEEK[name]
    return long_sql(LATEST, (SPEC_2 if keep is _weekday else SPEC_1).pick((7,), keep))


def attached_sql(keys: tuple[str, ...], prefix: str) -> str:
    on = " AND ".join(f"e.{k} = g.{k}" for k in keys)
    return f"""{base()},
e AS (SELECT * FROM pe WHERE (SELECT max(date_day) FROM pe) - date_day BETWEEN 0 AND 6),
g AS (SELECT {', '.join(keys)}, count(DISTINCT date_day) AS a, count(*) AS n, sum(vts) AS s FROM e GROUP BY ALL)
SELECT e.did, e.vid, e."timestamp", {shown('e.vts', 'vts')}, e.cid, e.is_intact, e.date_day,
  a AS {prefix}_active_days, n AS {prefix}_watch_nums, {shown('s', f'{prefix}_watch_durations')}
FROM e LEFT JOIN g ON {on}"""


def carried(cat: Catalogue) -> str:
    r2 = ", ".join(
        f"1 - sum(({y} - {y}_p) * ({y} - {y}_p)) / sum(({y} - {y}_m) * ({y} - {y}_m)) AS r2_{y}" for y in LABELS
    )
    preds = ", ".join(f"coalesce(b.{y}, 0) AS {y}_p, avg(a.{y}) OVER () AS {y}_m" for y in LABELS)
    return f"""{base()},
{split_ctes(cat)},
{labels_cte(cat)},
c AS (SELECT a.*, {preds} FROM la a LEFT JOIN la b ON a.did = b.did AND b.split = 'train_1' WHERE a.split = 'valid'),
r AS (SELECT {r2} FROM c)"""


_R2 = ", ".join(shown(f"r2_{y}", f"r2_{y}") for y in LABELS)


def clipped(expr: str, low, high=None) -> str:
    inner = expr if high is None else f"least({expr}, {high})"
    return f"CASE WHEN {expr} IS NOT NULL THEN greatest({inner}, {low}) END"


def two_predictions() -> str:
    return f"""{base(ORDERS)},
{split_ctes(SET_2)},
{labels_cte(SET_2)},
p1 AS (SELECT CAST(did AS VARCHAR) AS did, active_days, watch_nums, watch_durations FROM la WHERE split = 'valid'),
p2 AS (SELECT CAST(did AS VARCHAR) AS did, active_days, watch_nums, watch_durations FROM la WHERE split = 'train_1')"""


def _labels(cat: Catalogue, source: str = WATCH) -> str:
    return f"{base(source)},\n{split_ctes(cat)},\n{labels_cte(cat)}\n"


def _bounds(part: str, low: str, high: str) -> str:
    return f"""SELECT split, min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp,
  count(*) AS "rows", '{part}' AS part FROM lo JOIN sp ON date_day BETWEEN {low} AND {high} GROUP BY split"""


def _filter(name: str, cond: str) -> str:
    return f"""SELECT min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp, count(*) AS "rows",
  '{name}' AS "filter" FROM lo, mx WHERE {cond}"""


def _range_rows(columns: list[tuple[str, str, str]]) -> str:
    """Type names a range fits; no bound may be reached."""
    fits = " ".join(
        f"WHEN lo > {-(2 ** b)}::DOUBLE AND hi < {2 ** b - 1}::DOUBLE THEN '{n}'"
        for n, b in (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63))
    )
    parts = []
    for name, expr, stored in columns:
        fit = f"CASE {fits} END" if stored == "bigint" else "'float'"
        parts.append(
            f"SELECT '{name}' AS \"column\", {shown('lo', 'least')}, {shown('hi', 'greatest')},"
            f" '{stored}' AS stored, {fit} AS fitting"
            f" FROM (SELECT CAST(min({expr}) AS DOUBLE) AS lo, CAST(max({expr}) AS DOUBLE) AS hi FROM la)"
        )
    return " UNION ALL ".join(parts)


def stump_ctes(cat: Catalogue, spec: Spec, learned: str) -> str:
    """``best``: for each model ``k`` and label the split that takes most squared error away, among all of all features.

    ``learned`` gives the models, rows (k, condition on u).
    """
    some = spec.pick((7,), lambda f: f.name in STUMP_FEATURES)
    values = ", ".join(f"{{'feature': {i}, 'x': coalesce(CAST(lf.{quote(f.name)} AS DOUBLE), -1e6::DOUBLE)}}" for i, f in enumerate(some.features))
    names = ", ".join(f"{{'label': '{y}', 'y': CAST(r.{y} AS DOUBLE)}}" for y in LABELS)
    return f"""{base()},
{split_ctes(cat)},
{labels_cte(cat)},
{feature_ctes(cat, some)},
rw AS (SELECT split, did, active_days, watch_nums, watch_durations FROM la UNION ALL SELECT DISTINCT 'test', did, NULL, NULL, NULL FROM lo),
fo AS (
  SELECT did, CAST((row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(did AS VARCHAR))), did) - 1) % 5 AS INTEGER) AS fold
  FROM (SELECT DISTINCT did FROM rw WHERE split <> 'test')),
one AS (
  SELECT r.split, r.did, fold, unnest([{values}]) AS f, [{names}] AS labels
  FROM rw r LEFT JOIN lf ON r.split = lf.split AND r.did = lf.did LEFT JOIN fo ON r.did = fo.did),
two AS (SELECT split, did, fold, f, unnest(labels) AS l FROM one),
u AS (SELECT split, did, fold, f.feature AS feature, f.x AS x, l.label AS label, l.y AS y FROM two),
t AS (
  SELECT k, label, feature, x, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS q
  FROM u JOIN ({learned}) m ON m.fold IS DISTINCT FROM u.fold AND coalesce(m.split, u.split) = u.split
  WHERE u.split <> 'test' AND y IS NOT NULL GROUP BY ALL),
c AS (
  SELECT *, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(q) OVER w AS lq, sum(n) OVER p AS wn, sum(s) OVER p AS ws, sum(q) OVER p AS wq,
         lead(x) OVER w AS nx FROM t
  WINDOW w AS (PARTITION BY k, label, feature ORDER BY x), p AS (PARTITION BY k, label, feature)),
g AS (
  SELECT *, (wq - ws * ws / wn) / wn - ln / wn * ((lq - ls * ls / ln) / ln)
    - (wn - ln) / wn * (((wq - lq) - (ws - ls) * (ws - ls) / (wn - ln)) / (wn - ln)) AS gain FROM c WHERE nx IS NOT NULL),
best AS (
  SELECT k, label, feature, (x + nx) / 2 AS threshold, ls / ln AS low, (ws - ls) / (wn - ln) AS high, gain * wn AS gain
  FROM g WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY k, label ORDER BY gain DESC, feature, x) = 1)"""


_BY_FOLD = "SELECT unnest(range(5)) AS k, CAST(unnest(range(5)) AS INTEGER) AS fold, NULL AS split"
_BY_SPLIT = "SELECT * FROM (VALUES ('valid', -1, 'train_1'), ('test', -1, 'valid')) AS m(k, fold, split)"
_LEAF = "CASE WHEN x <= threshold THEN low ELSE high END"


def importance_stump() -> str:
    names = [f.wide(7) for f in SPEC_1.pick((7,), lambda f: f.name in STUMP_FEATURES).features]
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    columns = ", ".join(
        f"count(*) FILTER (k = {f}) AS importance_{f}, " + shown(f"coalesce(sum(gain) FILTER (k = {f}), 0)", f"importance_gain_{f}") for f in range(5))
    labels = ", ".join(f"('{y}')" for y in LABELS)
    return f"""{stump_ctes(SET_1, SPEC_1, _BY_FOLD)}
SELECT n.name AS "Feature", l.label, {columns}
FROM (VALUES {rows}) AS n(feature, name) CROSS JOIN (VALUES {labels}) AS l(label) LEFT JOIN best ON best.feature = n.feature AND best.label = l.label
GROUP BY n.name, l.label"""


def test_stump() -> str:
    means = ", ".join(f"avg({_LEAF}) FILTER (u.label = '{y}') AS {y}" for y in LABELS)
    return f"""{stump_ctes(SET_1, SPEC_1, _BY_FOLD)},
z AS (SELECT did, {means} FROM best JOIN u ON u.label = best.label AND u.feature = best.feature WHERE split = 'test' GROUP BY did)
SELECT CAST(did AS BIGINT) AS did, {shown(clipped('active_days', 1, 7), 'active_days')}, {shown(clipped('watch_nums', 0), 'watch_nums')},
  {shown(clipped('watch_durations', 0), 'watch_durations')} FROM z"""


_BANDS = " ".join(f"WHEN anchor - date_day < {d} THEN {d}" for d in SPEC_1.windows)

ORACLE: dict[str, str] = {
    "prep_events": f"""{base()} SELECT did, vid, {shown('vts', 'vts')}, "timestamp", date_day, date_weekday,
  cid, is_intact, classify_id, series_id, {shown('u_date', 'u_date')}, {shown('"vts/duration"', 'vts/duration')},
  {shown('"vts/u_date"', 'vts/u_date')}, {shown('"vts/date_weekday"', 'vts/date_weekday')},
  {shown("pow(0.95, CAST((SELECT max(date_day) FROM pe) - date_day + 1 AS DOUBLE))", 'weight_95')} FROM pe""",
    "event_calendar": f"""{base()} SELECT did, vid, "timestamp", date_day,
  CAST(isodow(date_day) AS INTEGER) AS date_weekday,
  CAST((("timestamp" + 28800) % 86400) // 3600 AS INTEGER) AS date_hour,
  CAST(((("timestamp" + 28800) % 3600) // 60) % 10 AS INTEGER) AS date_minute FROM lo""",
    "window_bounds": f"""{base()}, {split_ctes(SET_1)}
{_bounds('label', 'l_first', 'l_last')} UNION ALL {_bounds('history', 'h_first', 'h_last')}""",
    "range_filters": f"""{base()}, mx AS (SELECT max(date_day) AS d, max("timestamp") AS t FROM lo)
{_filter('day_range_6', 'date_day BETWEEN d - 6 AND d')} UNION ALL
{_filter('lookback_7', 'd - date_day BETWEEN 0 AND 6')} UNION ALL
{_filter('instant_range_7', '"timestamp" BETWEEN t - 7 * 86400 AND t')}""",
    "days_stored": f"""{base()}, {split_ctes(SET_1)}, mt AS (SELECT max(date_day) AS d, max("timestamp") AS t FROM lo)
{_filter('day_range_6', 'date_day BETWEEN d - 6 AND d').replace('lo, mx', 'lo, mt')} UNION ALL
{_filter('lookback_7', 'd - date_day BETWEEN 0 AND 6').replace('lo, mx', 'lo, mt')} UNION ALL
{_filter('instant_range_7', '"timestamp" BETWEEN t - 7 * 86400 AND t').replace('lo, mx', 'lo, mt')} UNION ALL
SELECT min("timestamp"), max("timestamp"), count(*), 'labels_train_2' FROM lo JOIN sp ON date_day BETWEEN l_first AND l_last WHERE split = 'train_2'""",
    "user_anchors": f"""{base()},
b AS (SELECT did, min(date_day) AS f, max(date_day) AS l FROM lo GROUP BY did),
an AS (
  SELECT did, l AS anchor, 7 AS days FROM b UNION SELECT did, l, 60 FROM b UNION SELECT did, f + 13, 14 FROM b)
SELECT an.did, anchor, days, count(DISTINCT date_day) AS active_days, count(lo.did) AS watch_nums,
  CASE WHEN count(lo.did) = 0 THEN 0 ELSE {distinct('vid')} END AS videos, {shown('sum(vts)', 'watch_durations')}
FROM an LEFT JOIN lo ON an.did = lo.did AND lo.date_day BETWEEN anchor - (days - 1) AND anchor GROUP BY an.did, anchor, days""",
    "even_folds": f"""{_labels(SET_1)} SELECT split, did,
  CAST((row_number() OVER (ORDER BY md5(concat_ws('|', '42', split, CAST(did AS VARCHAR))), split, did) - 1) % 5 AS INTEGER) AS fold FROM la""",
    "coded_texts": f"""{base()}, {split_ctes(BASELINE)},
{feature_ctes(BASELINE, BASELINE_SPEC.pick(BASELINE_SPEC.windows, lambda f: f.block == "favourite"))},
k AS (SELECT split, did, cid_like, classify_id_like FROM lf WHERE days = 28),
a AS (SELECT cid_like AS v, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, cid_like) - 1 AS DOUBLE) AS code FROM k WHERE split <> 'test' AND cid_like IS NOT NULL GROUP BY cid_like),
b AS (SELECT classify_id_like AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, classify_id_like) - 1 AS DOUBLE) AS code FROM k WHERE split <> 'test' AND classify_id_like IS NOT NULL GROUP BY classify_id_like)
SELECT cid_like AS liked, split, did, coalesce(a.code, (SELECT count(*) FROM a)) AS cid_like,
  coalesce(b.code, (SELECT count(*) FROM b)) AS classify_id_like, a.n AS times
FROM k LEFT JOIN a ON cid_like = a.v LEFT JOIN b ON classify_id_like = b.v""",
    "csv_rejects": f"""{base()},
k AS (SELECT *, CASE (((vid + did) % 11) + 11) % 11 WHEN 0 THEN 'more' WHEN 1 THEN 'fewer' WHEN 2 THEN 'value' ELSE 'good' END AS kind FROM ev)
SELECT 'user ' || did AS what, count(*) AS "rows", {shown('sum(vts)', 'seconds')} FROM k WHERE kind = 'good' GROUP BY did
UNION ALL SELECT kind, count(*), NULL FROM k WHERE kind <> 'good' GROUP BY kind""",
    "oof_stump": f"""{stump_ctes(SET_1, SPEC_1, _BY_FOLD)}
SELECT split, did, u.fold, u.label, {shown(_LEAF, 'prediction')}
FROM best JOIN u ON u.fold = best.k AND u.label = best.label AND u.feature = best.feature WHERE split <> 'test'""",
    "test_stump": test_stump(),
    "importance_stump": importance_stump(),
    "holdout_stump": f"""{stump_ctes(SET_2, SPEC_2, _BY_SPLIT)}
SELECT k AS part, did, u.label, {shown(_LEAF, 'prediction')}
FROM best JOIN u ON u.split = best.k AND u.label = best.label AND u.feature = best.feature""",
    "labels_valid": f"{_labels(SET_1)} SELECT did, {shown_labels()} FROM la WHERE split = 'valid'",
    "labels_all_splits": f"{_labels(SET_1)} SELECT split, did, {shown_labels()} FROM la",
    "order_labels": f"{_labels(SET_2, ORDERS)} SELECT split, did, {shown_labels()} FROM la",
    "rolling_labels": f"{_labels(BASELINE)} SELECT split, did, {shown_labels()} FROM la",
    "split_membership": f"""{base()}, {split_ctes(SET_1)}
SELECT split, date_day, CASE {_BANDS} END AS band,
  {shown("pow(0.95, CAST(anchor - date_day + 1 AS DOUBLE))", 'weight')}, count(*) AS "rows"
FROM lo JOIN an ON date_day BETWEEN h_first AND anchor WHERE anchor - date_day < 120
GROUP BY split, date_day, anchor""",
    "users": f"{base()} SELECT DISTINCT did FROM ev",
    **{name: last_week(name) for name in LAST_WEEK},
    "attach_vid_7": attached_sql(("vid",), "vid"),
    "attach_did_cid_7": attached_sql(("did", "cid"), "did_cid"),
    "attach_kind_cid_7": attached_sql(("is_intact", "cid"), "is_intact_cid"),
    "item_row_count": f"{base()} SELECT did, vid, vts, \"timestamp\", count(*) OVER (PARTITION BY vid) AS g_vid FROM ev",
    "features_long_set_1": long_sql(SET_1, SPEC_1),
    "features_long_set_2": long_sql(SET_2, SPEC_2),
    "features_long_baseline": long_sql(BASELINE, BASELINE_SPEC),
    "order_features_set_1": long_sql(SET_1, SPEC_1, ORDERS),
    "sample_wide": wide_sql(SET_1, SPEC_1, SPEC_1.windows),
    "stacked_splits": wide_sql(SET_2, SPEC_2, SPEC_2.windows, ("train_3", "train_2", "train_1", "valid")),
    "baseline_sample": wide_sql(BASELINE, BASELINE_SPEC, BASELINE_SPEC.windows, tenure=True),
    "favourite_category": long_sql(BASELINE, BASELINE_SPEC.pick(BASELINE_SPEC.windows, lambda f: f.block == "favourite")),
    "unmatched_items": f"""{base()} SELECT did, count(*) AS watches, count(DISTINCT vid) AS videos,
  {shown('sum(vts)', 'seconds')}, CAST(0 AS BIGINT) AS ratios FROM pe WHERE coalesce(cid, '{WITHDRAWN}') = '{WITHDRAWN}' GROUP BY did""",
    "deduped_items": f"""{base()} SELECT did, cid, count(*) AS watches, {shown('sum(vts)', 'seconds')} FROM pe GROUP BY did, cid""",
    "sorted_predictions": f"""{_labels(SET_1)} SELECT CAST(did AS VARCHAR) AS did,
  CAST(row_number() OVER (ORDER BY did) AS INTEGER) AS place FROM la WHERE split = 'valid'""",
    "csv_samples": wide_sql(BASELINE, BASELINE_SPEC, BASELINE_SPEC.windows),
    "preview": f"""{_labels(SET_1)} SELECT did, {shown_labels()} FROM la WHERE split = 'valid' ORDER BY did LIMIT 5""",
    "top_categories": f"""{base()},
c AS (SELECT did, classify_id, count(*) AS "rows" FROM pe WHERE classify_id IS NOT NULL GROUP BY ALL)
SELECT * FROM (SELECT did, classify_id, "rows",
  CAST(row_number() OVER (PARTITION BY did ORDER BY "rows" DESC, classify_id DESC) AS INTEGER) AS rank FROM c)
WHERE rank <= 2""",
    "tenure": f"{base()}, {split_ctes(BASELINE)}, {TENURE[:-1]} SELECT split, did, {shown('activa_time', 'activa_time')} FROM te",
    "fold_assignment": f"""{_labels(SET_1)} SELECT split, did,
  CAST(CAST(concat('0x', substr(md5(concat_ws('|', '42', split, CAST(did AS VARCHAR))), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold
FROM la""",
    "r2_score": f"{carried(SET_2)} SELECT {_R2} FROM r",
    "composite_score": f"""{carried(SET_2)} SELECT {_R2},
  {shown('0.5 * r2_active_days + 0.25 * r2_watch_nums + 0.25 * r2_watch_durations', 'score')} FROM r""",
    "clip_predictions": f"""{_labels(SET_1)} SELECT did,
  {shown(clipped('(active_days * 2.5 - 9)', 1, 7), 'active_days')},
  {shown(clipped('(watch_nums * 2.5 - 9)', 0), 'watch_nums')},
  {shown(clipped('(watch_durations * 2.5 - 9)', 0), 'watch_durations')} FROM la WHERE split = 'valid'""",
    "blend_predictions": f"""{two_predictions()} SELECT p1.did,
  {shown(clipped('(0.5 * p1.active_days + 0.5 * p2.active_days)', 1, 7), 'active_days')},
  {shown('0.5 * p1.watch_nums + 0.5 * p2.watch_nums', 'watch_nums')},
  {shown('0.5 * p1.watch_durations + 0.5 * p2.watch_durations', 'watch_durations')}
FROM p1 LEFT JOIN p2 ON p1.did = p2.did""",
    "key_mismatch": f"""{two_predictions()} SELECT p1.did AS did1, p2.did AS did2
FROM p1 FULL JOIN p2 ON p1.did = p2.did WHERE p1.did IS NULL OR p2.did IS NULL""",
    "csv_tables": f"""{base()} SELECT CAST(did AS VARCHAR) AS did, CAST(vid AS VARCHAR) AS vid, {shown('vts', 'vts')},
  "timestamp", date_day, cid, is_intact, {shown('u_date', 'u_date')} FROM pe""",
    "range_profile": _labels(SET_1) + _range_rows([
        ("did", "did", "bigint"), ("active_days", "active_days", "bigint"), ("watch_nums", "watch_nums", "bigint"),
        ("watch_durations", "watch_durations", "double"),
    ]),
    "narrow_types": f"""{_labels(SET_1)} SELECT split, did, active_days, watch_nums,
  CAST(round(watch_durations, 0) AS FLOAT) AS watch_durations FROM la""",
}
