"""Change-log normalisation with stored, mergeable state.

A row of the normalised log carries the text maxima of its (entity, day,
attribute), so a late row can change stored rows of its day. The maximum of a set
is the maximum of its parts' maxima; so it is enough to keep, by day, the maxima
of each key next to the rows. A load then reads its own batch and the stored
parts of the days it touches, never the raw log:

* ``detail``: mapped rows, a part for each day and load;
* ``maxima``: the maxima of each key, a part for each day;
* ``changes``: the normalised rows, a part for each day.

All parts are written aside and switched at once (``sinks.store``). The table
does not depend on how the log is cut into loads or in what order they come; a
load that runs again, after a crash or by mistake, replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.operators.changes import GROUP_KEYS, drop_noops, exclude, map_codes
from entwise.sinks.store import Store

DETAIL, MAXIMA, CHANGES = "detail", "maxima", "changes"
MAXIMA_SCHEMA = "pbin string, trn_ts string, column_nm string, after string, before string"
_KEY = "day_and_load"


def maxima_of(detail: DataFrame) -> DataFrame:
    """(pbin, day, column) with the text maxima; keys with a NULL part belong to no group."""
    return (detail.dropna(subset=GROUP_KEYS).groupBy(*GROUP_KEYS)
            .agg(F.max("after_value").alias("after"), F.max("before_value").alias("before")))


def merged(*maxima: DataFrame) -> DataFrame:
    """Maxima of the union of the sets that the given maxima belong to."""
    out = maxima[0]
    for other in maxima[1:]:
        out = out.unionByName(other)
    return out.groupBy(*GROUP_KEYS).agg(F.max("after").alias("after"), F.max("before").alias("before"))


def load_changes(store: Store, batch: DataFrame, load: str | Column, excluded_users: Sequence[str] = ()) -> list[str]:
    """Load the raw change rows ``batch`` (``RAW_CHANGES_SCHEMA``) into the store and
    return the days that it changed.

    ``load`` names the load, or gives the name of each row's (a column expression,
    such as the file a row comes from): rows of a name replace those loaded under
    it for the same days before. Rows without a day are dropped, as their group is
    unknown. The driver sees the touched days and the store's manifest.
    """
    since = store.version()
    named = batch.withColumn("_load", load if isinstance(load, Column) else F.lit(load))
    detail = exclude(map_codes(named), excluded_users).dropna(subset=["trn_ts"]) \
        .withColumn(_KEY, F.concat_ws("|", "trn_ts", "_load"))
    new = store.stage(detail.select(*S.RAW_CHANGES_SCHEMA.fieldNames(), _KEY), by=_KEY)
    days = sorted({key.split("|", 1)[0] for key in new})
    if not days:
        return []
    touched = set(days)
    old = {p: f for (t, p), f in store.manifest(since).items()
           if t == DETAIL and p.split("|", 1)[0] in touched and p not in new}
    added = store.files(new.values(), S.RAW_CHANGES_SCHEMA)
    tops = store.stage(merged(maxima_of(added), store.read(MAXIMA, MAXIMA_SCHEMA, days, since)), by="trn_ts")
    rows = store.files([*old.values(), *new.values()], S.RAW_CHANGES_SCHEMA)
    # both sides are plain scans, so AQE splits a key that very many rows share
    out = drop_noops(rows.join(store.files(tops.values(), MAXIMA_SCHEMA), GROUP_KEYS)).select(*S.CHANGES_LAYOUT)
    done = store.stage(out, by="trn_ts")
    store.commit({DETAIL: new, MAXIMA: tops, CHANGES: {d: done.get(d) for d in days}}, since=since)
    return days


def changes(store: Store, days: Sequence[str] | None = None) -> DataFrame:
    """The normalised rows, of the given days alone if any are named."""
    return store.read(CHANGES, S.CHANGES_SCHEMA, days).select(*S.CHANGES_LAYOUT)
