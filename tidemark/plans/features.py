"""The feature build: every window of every split from one table of daily cells.

1. Events shrink to cells, one per (user, video, local day), holding mergeable sums.
   This is the only shuffle of event rows and it combines on the map side.
2. Cells are stored by user, so that every per-user grouping below is local and reads them
   without a shuffle. Users too heavy for one task stay unplaced: the same code then runs with
   Spark's ordinary two-step aggregations, which spread them over finer keys.
3. A cell meets a split at most once and carries its smallest window (``band``). Groups
   are aggregated per band and only the small results are repeated per window.
4. Item aggregates are made per (split, video) with one array slot per window, get the
   kind-collection aggregates attached there, and meet the users' cells in one join.

The result is long: ``split, days, did`` and one column per feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import moments
from tidemark.functions.clock import DAY_SECONDS
from tidemark.operators.joins import BROADCAST_BYTES, Heavy, lookup_join
from tidemark.plans.spec import CID_KEYS, ITEM_KEYS, KIND_KEYS, Feature, Spec
from tidemark.plans.splits import CALENDAR, Layout, prune, window_bands, window_members
from tidemark.session import settle, settle_by

DIMS = ("cid", "is_intact", "classify_id", "series_id")
USER_WINDOW = ("did", "split", "days")

Place = Callable[[DataFrame], DataFrame]


def _measures(spec: Spec) -> list[str]:
    keys = [f.arg[1] for f in spec.features if f.block == "base" and f.kind == "stat"]
    return list(dict.fromkeys(["vts", *keys]))


def _dims(spec: Spec) -> list[str]:
    blocks, used = spec.blocks(), {f.arg[0] for f in spec.features if f.kind in ("distinct", "favourite")}
    if "item" in blocks:
        used |= {"cid", "is_intact"}
    if "cid" in blocks:
        used.add("cid")
    if any(f.kind.startswith("kind_") for f in spec.features):
        used.add("is_intact")
    return [d for d in DIMS if d in used]


def _weighted(spec: Spec) -> bool:
    return any(f.kind == "stat" and f.arg[0] == "w95" for f in spec.features)


def daily_cells(prepared: DataFrame, layout: Layout, spec: Spec) -> DataFrame:
    """Mergeable sums per user, video and local day.

    Calendar windows consist of whole days, so cells need no split yet. Rolling windows
    cut through days: there the cells are also keyed by split and band.
    """
    keys = ["did", "vid", "date_day", *_dims(spec)]
    rows = prune(prepared, layout, max(spec.windows))
    if layout.mode != CALENDAR:
        rows = window_members(rows, layout, spec.windows)
        if not _weighted(spec):
            rows = rows.withColumn("weight", F.lit(1.0))
        keys += ["split", "band", "weight"]
    parts = [c for m in _measures(spec) for c in moments.first_parts(m)]
    return rows.groupBy(*keys).agg(
        F.expr("count(1) AS n"),
        F.expr("min(timestamp) AS t_lo"),
        F.expr("max(timestamp) AS t_hi"),
        *parts,
    )


def _members(cells: DataFrame, layout: Layout, spec: Spec) -> DataFrame:
    return window_members(cells, layout, spec.windows) if layout.mode == CALENDAR else cells


def _time_keys(layout: Layout) -> list[str]:
    return ["date_day"] if layout.mode == CALENDAR else ["date_day", "split", "band"]


def _windows_from(spec: Spec) -> Column:
    """Rows for every window that holds the row's ``band``."""
    every = ", ".join(map(str, spec.windows))
    return F.expr(f"explode(filter(array({every}), d -> d >= band))")


def _per_window(spec: Spec, **values: str) -> list[Column]:
    """Sums of each value over the bands of each window, as ``name_i`` columns."""
    return [
        F.expr(f"sum(if(band <= {d}, {v}, NULL)) AS {name}_{i}")
        for i, d in enumerate(spec.windows)
        for name, v in values.items()
    ]


def _slots(spec: Spec, sums: str, name: str) -> Column:
    return F.expr(f"array({', '.join(f'{sums}_{i}' for i in range(len(spec.windows)))}) AS `{name}`")


def _open_windows(df: DataFrame, spec: Spec, keep: list[str], sums: str) -> DataFrame:
    """One row per window in which the group has rows, with that window's ``sums``.

    ``slot`` is the window's place in the arrays of item aggregates.
    """
    rows = ", ".join(
        f"named_struct('slot', {i}, 'days', {d}, "
        + ", ".join(f"'{c}', {c}_{i}" for c in sums) + ")"
        for i, d in enumerate(spec.windows)
    )
    return df.select(*keep, F.expr(f"inline(array({rows}))")).where("n > 0")


def _finish(df: DataFrame, spec: Spec, block: str) -> DataFrame:
    return df.select(*USER_WINDOW, *[
        F.expr(f"{_value(f, spec)} AS `{f.name}`") for f in spec.features if f.block == block
    ])


def _value(f: Feature, spec: Spec) -> str:
    def filled(total: str) -> str:
        return total if spec.fill_empty is None else f"coalesce({total}, {float(spec.fill_empty)}D)"

    if f.kind == "stat":
        stat, key = f.arg
        value = moments.statistic(stat, key, spec.normalized)
        value = filled(value) if stat == "sum" else value
    elif f.kind == "kind_sum":
        value = filled(f"kind_{f.arg[0]}_s")
    elif f.kind == "kind_rows":
        value = f"coalesce(kind_{f.arg[0]}_n, 0)"
    elif f.kind == "rows":
        value = "n"
    elif f.kind == "span":
        # the rolling set once took milliseconds for seconds
        value = f"(t_hi - t_lo) / {3.6 if spec.compat and spec.mode != CALENDAR else 3600.0}D"
    elif f.kind == "distinct":
        value = f"{f.arg[0]}_d"
    elif f.kind == "day_share":
        value = f"{f.arg[0]}_d / days"
    else:
        raise ValueError(f.kind)
    # a feature that a short window does not have stays NULL there
    return value if f.since <= min(spec.windows) else f"if(days >= {f.since}, {value}, NULL)"


def _stat_parts(spec: Spec, block: str) -> dict[str, list[str]]:
    """Measures of a block and the sums their statistics are rebuilt from."""
    stats: dict[str, list[str]] = {}
    for f in spec.features:
        if f.block == block and f.kind == "stat":
            stats.setdefault(f.arg[1], []).append(f.arg[0])
    return {m: moments.needed(s, spec.normalized) for m, s in stats.items()}


def _centres(cells: DataFrame, measures: list[str], crowded: bool) -> DataFrame:
    """``cells`` with each user's smallest value of the measures, as the centre of their squares.

    Placed users have theirs by a window over rows that lie together; the few heavy ones,
    spread as they are, by a lookup with one row for each.
    """
    least = [F.expr(f"min(`{m}_lo`) AS `{m}_c`") for m in measures]
    if not measures:
        return cells
    if crowded:
        return cells.join(F.broadcast(cells.groupBy("did").agg(*least)), "did")
    here = Window.partitionBy("did")
    return cells.withColumns({f"{m}_c": F.min(f"`{m}_lo`").over(here) for m in measures})


def _spread_columns(opened: DataFrame, parts: dict[str, list[str]], source: dict[str, str], crowded: bool) -> DataFrame:
    """``opened`` with the smallest value of each deviation's column in its user's window, as the centre of its squares.

    A user's values may be large and differ by little; about one of themselves their squares keep all digits.
    """
    columns = list(dict.fromkeys(source.get(k, k) for k, ps in parts.items() if "q" in ps))
    if not columns:
        return opened
    least = {f"_c_{c}": f"min(`{c}`)" for c in columns}
    if crowded:
        found = opened.groupBy(*USER_WINDOW).agg(*[F.expr(f"{e} AS `{n}`") for n, e in least.items()])
        return opened.join(F.broadcast(found), list(USER_WINDOW))
    here = Window.partitionBy(*USER_WINDOW)
    return opened.withColumns({n: F.expr(e).over(here) for n, e in least.items()})


def _repeated(opened: DataFrame, parts: dict[str, list[str]], source: dict[str, str], crowded: bool) -> DataFrame:
    """Parts per user's window of values (in the columns ``source`` names) that stand for ``n`` rows of weight ``w``."""
    rows = _spread_columns(opened, parts, source, crowded)
    return rows.groupBy(*USER_WINDOW).agg(*[c for k, ps in parts.items() for c in moments.repeated_parts(
        k, source.get(k, k), "n", "w", ps, f"`_c_{source.get(k, k)}`")])


def _base_block(cells: DataFrame, layout: Layout, spec: Spec, crowded: bool = False) -> DataFrame:
    kinds = list(dict.fromkeys(f.arg[0] for f in spec.features if f.kind.startswith("kind_")))
    parts = _stat_parts(spec, "base")
    weighted = {f"{m}_{p}": f"{m}_{p[1:] or 's'}" for m, ps in parts.items() for p in ps if p in ("w", "wn")}
    spread = [m for m, ps in parts.items() if "q" in ps]
    about = {c: e for m in spread for c, e in moments.centred(m, f"`{m}_c`").items()}
    rows = _members(_centres(cells, spread, crowded).withColumns(about), layout, spec).withColumns(
        {w: F.expr(f"`{plain}` * weight") for w, plain in weighted.items()}
    )
    merge = [
        F.expr("sum(n) AS n"), F.expr("min(t_lo) AS t_lo"), F.expr("max(t_hi) AS t_hi"),
        *[c for m, ps in parts.items() for c in moments.merged_parts(m, ps)],
    ]
    banded = rows.groupBy("did", "split", "band").agg(
        *merge,
        *[F.expr(f"sum(if(is_intact = {k}, vts_s, NULL)) AS kind_{k}_s") for k in kinds],
        *[F.expr(f"sum(if(is_intact = {k}, n, NULL)) AS kind_{k}_n") for k in kinds],
    )
    full = banded.withColumn("days", _windows_from(spec)).groupBy(*USER_WINDOW).agg(
        *merge, *[F.expr(f"sum(kind_{k}_{p}) AS kind_{k}_{p}") for k in kinds for p in "sn"]
    )
    return _finish(full, spec, "base")


def _day_words(layout: Layout, spec: Spec) -> dict[str, str]:
    """Days as bits: for each word of 63 days back from the last anchor, the bit of a row's local day."""
    unit = 1 if layout.mode == CALENDAR else DAY_SECONDS
    anchors = [s.anchor // unit for s in layout.splits if s.anchor is not None] or [0]
    last = max(anchors) + 1  # in local time an instant's day may be the next
    back = f"({last} - unix_date(date_day))"
    reach = last - min(anchors) + max(spec.windows) + 1
    return {f"days_{k}": f"if({back} div 63 = {k}, shiftleft(1L, CAST({back} % 63 AS INT)), 0L)" for k in range(reach // 63 + 1)}


def _distinct_block(cells: DataFrame, layout: Layout, spec: Spec) -> DataFrame:
    """Exact distinct counts: a value counts in every window from its first band on.

    Days are bits of a few words, joined by or and counted at the end: no row is made for a day.
    """
    names = list(dict.fromkeys(f.arg[0] for f in spec.features if f.block == "distinct"))
    values = [c for c in names if c != "date_day"]
    rows, made, sums = _members(cells, layout, spec), [], []
    if values:
        tokens = ", ".join(f"named_struct('what', '{c}', 'value', CAST({c} AS STRING))" for c in values)
        # grouping keeps NULL as one value, as intended
        bands = window_bands(layout, spec.windows) if layout.mode == CALENDAR else {}
        if bands:  # a column per split, so that a value is grouped once and not for each split
            least = [F.min(f"_b{i}").alias(f"_b{i}") for i in range(len(bands))]
            found = cells.select("did", *[b.alias(f"_b{i}") for i, b in enumerate(bands.values())], F.expr(f"inline(array({tokens}))")).groupBy(
                "did", "what", "value").agg(*least)
            splits = ", ".join(f"named_struct('split', '{s}', 'band', _b{i})" for i, s in enumerate(bands))
            first = found.select("did", "what", F.expr(f"inline(array({splits}))")).where("band IS NOT NULL")
        else:
            first = rows.select("did", "split", "band", F.expr(f"inline(array({tokens}))")).groupBy("did", "split", "what", "value").agg(
                F.expr("min(band) AS band"))
        made.append(first.groupBy("did", "split", "band").agg(*[F.expr(f"count_if(what = '{c}') AS {c}_d") for c in values]))
        sums += [F.expr(f"sum({c}_d) AS {c}_d") for c in values]
    words = _day_words(layout, spec) if "date_day" in names else {}
    if words:
        made.append(rows.groupBy("did", "split", "band").agg(*[F.expr(f"bit_or({bit}) AS {w}") for w, bit in words.items()]))
        sums.append(F.expr(" + ".join(f"bit_count(bit_or({w}))" for w in words)).cast("long").alias("date_day_d"))
    banded = made[0] if len(made) == 1 else made[0].unionByName(made[1], allowMissingColumns=True)
    full = banded.withColumn("days", _windows_from(spec)).groupBy(*USER_WINDOW).agg(*sums)
    return _finish(full, spec, "distinct")


def item_aggregates(cells: DataFrame, layout: Layout, spec: Spec, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Per (split, vid): arrays, one slot per window, of the item's own aggregates and of
    those of its kind and collection."""
    time = _time_keys(layout)
    used = {f.arg[1] for f in spec.features if f.block == "item"}

    def totals(keys: list[str]) -> DataFrame:
        daily = cells.groupBy(*keys, *time).agg(F.sum("n").alias("n"), F.sum("vts_s").alias("vts_s"))
        member = _members(daily, layout, spec)
        return member.groupBy("split", *keys).agg(*_per_window(spec, a="1", n="n", s="vts_s"))

    def named(prefix: str) -> list[Column]:
        # active days need whole-day windows: one group row per day
        return [
            _slots(spec, part, f"{prefix}_{name}")
            for part, name in (("a", "active_days"), ("n", "watch_nums"), ("s", "watch_durations"))
            if f"{prefix}_{name}" in used
        ]

    items = totals(["vid", "cid", "is_intact"])
    own = items.select(
        "split", "vid", "cid", "is_intact", *named("vid"),
        *([_slots(spec, "n", "g_vid")] if "g_vid" in used else []),
    )
    if not used & set(KIND_KEYS):
        return own.drop("cid", "is_intact")
    kinds = totals(["is_intact", "cid"]).where("is_intact IS NOT NULL AND cid IS NOT NULL")
    kinds = kinds.select("split", "is_intact", "cid", *named("is_intact_cid"))
    # item-sized on the left: a large collection is at most its number of videos here
    joined = lookup_join(
        own, kinds, ["split", "is_intact", "cid"],
        right_rows=_item_rows(layout), row_bytes=_item_bytes(spec, 3),
        heavy=Heavy(nulls=True), spread_on=["vid"], limit=limit,
    )
    return joined.drop("cid", "is_intact")


def _item_rows(layout: Layout) -> int | None:
    return None if layout.items_seen is None else layout.items_seen * len(layout.splits)


def _item_bytes(spec: Spec, values: int) -> int:
    return 96 + values * (24 + 8 * len(spec.windows))


def _item_block(
    cells: DataFrame, items: DataFrame, layout: Layout, spec: Spec, place: Place, limit: int, crowded: bool
) -> DataFrame:
    parts = _stat_parts(spec, "item")
    per_item = _members(cells, layout, spec).groupBy("did", "split", "vid").agg(
        *_per_window(spec, n="n", w="n * weight")
    )
    size = {
        "right_rows": _item_rows(layout),
        "row_bytes": _item_bytes(spec, len(parts)),
    }
    joined = lookup_join(
        per_item, items, ["split", "vid"], **size,
        heavy=layout.items, spread_on=["did"], limit=limit,
    )
    if size["right_rows"] is None or size["right_rows"] * size["row_bytes"] > limit:
        joined = place(joined)  # the shuffle join moved the rows to the items
    opened = _open_windows(joined, spec, ["did", "split", *parts], "nw")
    opened = opened.select(
        *USER_WINDOW, "n", "w", *[F.expr(f"get({k}, slot) AS {k}") for k in parts]
    )
    return _finish(_repeated(opened, parts, {}, crowded), spec, "item")


def _cid_block(cells: DataFrame, layout: Layout, spec: Spec, crowded: bool) -> DataFrame:
    """The user's collection aggregates need no join: the group is the user's own."""
    parts = _stat_parts(spec, "cid")
    rows = _members(cells.where("cid IS NOT NULL"), layout, spec)
    daily = rows.groupBy("did", "split", "cid", "date_day", "band").agg(
        F.expr("sum(n) AS n"), F.expr("sum(vts_s) AS vts_s"), F.expr("sum(n * weight) AS w")
    )
    totals = daily.groupBy("did", "split", "cid").agg(
        *_per_window(spec, a="1", n="n", s="vts_s", w="w")
    )
    opened = _open_windows(totals, spec, ["did", "split"], "nwas")
    source = dict(zip(CID_KEYS, "ans", strict=True))
    return _finish(_repeated(opened, parts, source, crowded), spec, "cid")


def _favourite_block(cells: DataFrame, layout: Layout, spec: Spec) -> DataFrame:
    """Most watched value per user and window; ties go to the largest value, NULL never wins."""
    features = [f for f in spec.features if f.block == "favourite"]
    member = _members(cells, layout, spec)
    out = None
    for f in features:  # one by one: each value keeps its own type and order
        counts = member.where(f"`{f.arg[0]}` IS NOT NULL").groupBy("did", "split", F.col(f.arg[0]).alias("value")).agg(
            *_per_window(spec, n="n"))
        opened = _open_windows(counts, spec, ["did", "split", "value"], "n")
        best = opened.groupBy(*USER_WINDOW).agg(F.expr(f"max(struct(n, value)).value AS `{f.name}`"))
        out = best if out is None else out.join(best, list(USER_WINDOW), "full")
    return out


def _user_features(
    cells: DataFrame, items: DataFrame | None, layout: Layout, spec: Spec, place: Place, limit: int,
    crowded: bool = False,
) -> DataFrame:
    blocks = spec.blocks()
    made, out = [], None
    if "base" in blocks:
        made.append(_base_block(cells, layout, spec, crowded))
    if "distinct" in blocks:
        made.append(_distinct_block(cells, layout, spec))
    if "cid" in blocks:
        made.append(_cid_block(cells, layout, spec, crowded))
    if "item" in blocks:
        made.append(_item_block(cells, items, layout, spec, place, limit, crowded))
    if len(made) == 1:
        out = made[0]
    elif made:
        # blocks share the key but no column: stack them and fold, which keeps the
        # placement by user, where a chain of joins would shuffle every block again
        stacked = made[0]
        for block in made[1:]:
            stacked = stacked.unionByName(block, allowMissingColumns=True)
        names = [c for c in stacked.columns if c not in USER_WINDOW]
        out = stacked.groupBy(*USER_WINDOW).agg(*[F.expr(f"max(`{c}`) AS `{c}`") for c in names])
    if "favourite" in blocks:
        liked = _favourite_block(cells, layout, spec)
        out = liked if out is None else out.join(liked, list(USER_WINDOW), "left")
    return out


def long_features(
    prepared: DataFrame,
    layout: Layout,
    spec: Spec,
    *,
    keep_cells: bool | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All windows of all splits: one row per ``split, days, did`` with any history.

    ``keep_cells`` writes the daily cells to the shared folder once, so that the blocks
    do not each repeat the scan and the item join; by default it does when there are
    several blocks.
    """
    blocks = spec.blocks()
    cells = daily_cells(prepared, layout, spec)
    heavy = layout.users
    # a missing user id is heavy or not, so every row is in exactly one part
    marked = heavy.marked(cells, "did", "_crowd") if heavy.any else cells.withColumn("_crowd", F.lit(False))
    keep = len(blocks) > 1 if keep_cells is None else keep_cells
    if keep and heavy.any:
        marked = settle(marked, "cells")
    ordinary = marked.where("NOT _crowd").drop("_crowd")

    def by_user(df: DataFrame) -> DataFrame:
        return df.repartition("did")

    # stored by user: every block below reads its columns where they lie
    placed = settle_by(ordinary, "did", "cells_by_user") if keep else by_user(ordinary)
    crowded = marked.where("_crowd").drop("_crowd") if heavy.any else None
    cells = placed if crowded is None else placed.unionByName(crowded)
    items = item_aggregates(cells, layout, spec, broadcast_bytes) if "item" in blocks else None
    out = _user_features(placed, items, layout, spec, by_user, broadcast_bytes)
    if crowded is not None:
        out = out.unionByName(
            _user_features(crowded, items, layout, spec, lambda df: df, broadcast_bytes, True)
        )
    ratios = [
        F.try_divide(F.col(f.arg[0]), F.col(f.arg[1])).alias(f.name)
        for f in spec.features if f.kind == "ratio"
    ]
    order = [f.name for f in spec.features]
    return out.select("*", *ratios).select("split", "days", "did", *order)
