"""What one look-back window yields, for each of the three feature sets.

A feature is named by its wide-sample template (``{d}`` is the window length) and lives
in one block; blocks are the groupings the build can compute on their own:

- ``base``      counts, spans, kind sums and statistics of event values per user
- ``distinct``  exact distinct counts per user
- ``item``      statistics, over a user's events, of item and kind-collection aggregates
- ``cid``       statistics of the user's own collection aggregates
- ``favourite`` most watched category values
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from tidemark.plans.splits import CALENDAR, ROLLING

ITEM_KEYS = ("vid_active_days", "vid_watch_nums", "vid_watch_durations")
CID_KEYS = ("did_cid_active_days", "did_cid_watch_nums", "did_cid_watch_durations")
KIND_KEYS = (
    "is_intact_cid_active_days", "is_intact_cid_watch_nums", "is_intact_cid_watch_durations",
)
# always 1 in a one-day window
TRIVIAL_AT_ONE = ("vid_active_days", "did_cid_active_days", "is_intact_cid_active_days")


@dataclass(frozen=True)
class Feature:
    template: str
    block: str
    kind: str  # how the build computes it
    arg: tuple = ()
    since: int = 1  # smallest window that has it

    @property
    def name(self) -> str:
        """Column of the long table."""
        return self.template.replace("_{d}", "")

    def wide(self, days: int) -> str:
        return self.template.format(d=days)


@dataclass(frozen=True)
class Spec:
    name: str
    mode: str
    windows: tuple[int, ...]
    features: tuple[Feature, ...]
    fill_empty: float | None = None  # value of a sum over no rows; None keeps NULL
    normalized: bool = False  # divide weighted means by the weights
    compat: bool = False

    def at(self, days: int) -> list[Feature]:
        return [f for f in self.features if f.since <= days]

    def wide_columns(self, windows: tuple[int, ...] | None = None) -> list[str]:
        return [f.wide(d) for d in (windows or self.windows) for f in self.at(d)]

    def blocks(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(f.block for f in self.features if f.block != "ratio"))

    def pick(self, windows: tuple[int, ...], keep) -> Spec:
        """A smaller set: some windows, and the features for which ``keep`` holds."""
        return replace(self, windows=windows, features=tuple(f for f in self.features if keep(f)))


def _stats(key: str, block: str, stats, since: int = 1, label: str | None = None) -> list[Feature]:
    out = []
    for stat in stats:
        head, tail = ("w95_did", "mean") if stat == "w95" else ("did", stat)
        out.append(Feature(f"{head}_{label or key}_{{d}}_{tail}", block, "stat", (stat, key), since))
    return out


def _kinds(always, later) -> list[Feature]:
    out = []
    for k, since in [(k, 1) for k in always] + [(k, 2) for k in later]:
        out.append(Feature(f"is_intact_{k}_vts_{{d}}", "base", "kind_sum", (k,), since))
        out.append(Feature(f"is_intact_{k}_vid_{{d}}", "base", "kind_rows", (k,), since))
    return out


def _counts(distinct, days_since: int, share: bool, span: str) -> list[Feature]:
    out = [
        Feature("did_vid_{d}_count", "base", "rows"),
        Feature("did_vid_{d}_nunique", "distinct", "distinct", ("vid",)),
        Feature("did_vid_{d}_nunique_count", "ratio", "ratio", ("did_vid_nunique", "did_vid_count")),
        Feature(span, "base", "span"),
        Feature("did_date_{d}_nunique", "distinct", "distinct", ("date_day",), days_since),
    ]
    if share:
        out.append(Feature("did_date/days_{d}_nunique", "distinct", "day_share", ("date_day",), days_since))
    return out + [Feature(f"did_{c}_{{d}}_nunique", "distinct", "distinct", (c,)) for c in distinct]


def _attached(stats) -> list[Feature]:
    out = []
    for block, keys in (("item", ITEM_KEYS), ("cid", CID_KEYS), ("item", KIND_KEYS)):
        for key in keys:
            out += _stats(key, block, stats, 2 if key in TRIVIAL_AT_ONE else 1)
    return out


WINDOWS = (1, 3, 5, 7, 15, 30, 60, 120)

_FULL = ("w95", "mean", "std", "min", "max")
_SHORT = ("w95", "mean", "std")

SPEC_1 = Spec(
    "set_1", CALENDAR, WINDOWS,
    tuple(
        _kinds((1, 2, 3, 4, 7), (9,))
        + _counts(("cid", "classify_id", "series_id"), 2, True, "ts_ptp_{d}")
        + _stats("vts", "base", (*_FULL, "sum"))
        + _stats("u_date", "base", (*_FULL, "sum"))
        + _stats("vts/duration", "base", _FULL)
        + _attached(_FULL)
    ),
)

SPEC_2 = Spec(
    "set_2", CALENDAR, WINDOWS,
    tuple(
        _kinds((1, 2, 3, 4, 7), ())
        + _counts(("cid", "classify_id", "series_id"), 2, True, "ts_ptp_{d}")
        + _stats("vts", "base", (*_SHORT, "sum"))
        + _stats("u_date", "base", (*_SHORT, "sum"))
        + _stats("vts/duration", "base", _SHORT)
        + _stats("vts/u_date", "base", _SHORT)
        + _attached(_SHORT)
        + _stats("vts/date_weekday", "base", _SHORT, since=7)
    ),
)

BASELINE_SPEC = Spec(
    "baseline", ROLLING, (1, 3, 5, 7, 14, 28),
    tuple(
        _counts(("cid", "classify_id"), 1, False, "timestamp_ptp_{d}")
        + [
            Feature("cid_like_{d}", "favourite", "favourite", ("cid",)),
            Feature("classify_id_like_{d}", "favourite", "favourite", ("classify_id",)),
        ]
        + _stats("vts", "base", ("mean", "std", "min", "max", "sum"))
        + _stats("g_vid", "item", ("mean", "std", "min", "max", "sum"), label="g_vid_{d}")
    ),
)
