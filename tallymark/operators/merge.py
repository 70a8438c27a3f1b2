"""Keyed merges: never-go-down posts, daily snapshots, last write wins, insert only.

Duplicates are folded by aggregates before anything is shuffled, so a key that
holds a large share of the rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..config import Settings
from ..functions.numbers import or_zero, recomputed_rates
from ..functions.text import with_post_type

_DB_COLUMNS = ["date_collected", "created_at", "updated_at"]
_RATES = ["ctr", "engagement_rate"]


def last_per_key(df: DataFrame, keys: list[str], order: Column | str = "arrival") -> DataFrame:
    """The last row of each key (last write wins)."""
    others = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*others), order)
    return df.groupBy(*keys).agg(newest.alias("kept")).select(*keys, "kept.*")


def fold_posts(incoming: DataFrame, policy: str = "max") -> DataFrame:
    """One row per post id. ``max``: highest of each metric, the rest from the last row; ``new``: the last row."""
    if policy == "new":
        return last_per_key(incoming, K.POST_KEY)
    others = [c for c in incoming.columns if c not in (*K.POST_KEY, *K.METRICS)]
    folded = incoming.groupBy(*K.POST_KEY).agg(
        *[F.max(or_zero(F.col(m))).alias(m) for m in K.METRICS],
        F.max_by(F.struct(*others), "arrival").alias("kept"),
        F.count("*").alias("copies"),
    )
    rows = folded.select(*K.POST_KEY, *K.METRICS, "copies", "kept.*")
    fresh = recomputed_rates()
    rates = {r: F.when(F.col("copies") > 1, fresh[r]).otherwise(F.col(r)) for r in _RATES}
    return rows.withColumns(rates).select(*incoming.columns)


def _record_columns(base: DataFrame) -> list[str]:
    return [c for c in base.columns if c not in (*K.POST_KEY, *_DB_COLUMNS)]


def _merged(base: DataFrame, joined: DataFrame, policy: str, settings: Settings) -> DataFrame:
    """Columns ``b`` (the stored row, may be NULL) and ``i`` (the incoming row, may be NULL) to one row."""
    both = F.col("b").isNotNull() & F.col("i").isNotNull()
    untouched = F.col("i").isNull()
    names = _record_columns(base)
    available = set(joined.schema["i"].dataType.names)

    def field(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def supplied(name: str) -> Column:
        return field("i", name) if name in available else field("b", name)

    if policy == "max":
        metrics = {
            m: F.when(both, F.greatest(or_zero(field("b", m)), or_zero(field("i", m)))) for m in K.METRICS
        }
    else:
        metrics = {}
    picked = joined.select(
        *K.POST_KEY,
        both.alias("both"),
        *[
            F.coalesce(metrics[n], F.when(untouched, field("b", n)).otherwise(supplied(n))).alias(n)
            if n in metrics
            else F.when(untouched, field("b", n)).otherwise(supplied(n)).alias(n)
            for n in names
        ],
        F.coalesce(field("b", "date_collected"), F.when(~untouched, settings.now)).alias("date_collected"),
        F.when(F.col("b").isNull(), settings.now).otherwise(field("b", "created_at")).alias("created_at"),
        F.when(both, settings.now).otherwise(field("b", "updated_at")).alias("updated_at"),
    )
    if policy == "max":
        fresh = recomputed_rates()
        picked = picked.withColumns({r: F.when(F.col("both"), fresh[r]).otherwise(F.col(r)) for r in _RATES})
    return picked.select(*base.columns)


def merge_posts(base: DataFrame, incoming: DataFrame, settings: Settings) -> DataFrame:
    """The whole table after the merge.

    Stored rows keep ``date_collected`` and ``created_at``; under ``max`` no metric
    falls and the rates follow the merged metrics; under ``new`` the incoming row wins.
    """
    folded = fold_posts(incoming, settings.policy)
    stored = base.select(*K.POST_KEY, F.struct(*[c for c in base.columns if c not in K.POST_KEY]).alias("b"))
    fresh = folded.select(*K.POST_KEY, F.struct(*[c for c in folded.columns if c not in K.POST_KEY]).alias("i"))
    return _merged(base, stored.join(fresh, K.POST_KEY, "full_outer"), settings.policy, settings)


def upsert(base: DataFrame, incoming: DataFrame, keys: list[str], order: Column | str | None = None) -> DataFrame:
    """Last write wins on ``keys``; columns the incoming rows do not supply keep their stored values."""
    fresh = incoming if order is None else last_per_key(incoming, keys, order)
    kept = [c for c in base.columns if c not in fresh.columns]
    if kept:
        fresh = fresh.join(base.select(*keys, *kept), keys, "left")
    rest = base.join(fresh.select(*keys), keys, "left_anti")
    return rest.unionByName(fresh.select(*base.columns))


def first_per_key(df: DataFrame, keys: list[str], order: Column | str = "arrival") -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("kept")).select(*keys, "kept.*")


def insert_only(base: DataFrame, incoming: DataFrame, keys: list[str], order: Column | str | None = "arrival") -> DataFrame:
    """The incoming rows whose key is not stored yet, one per key (the first to arrive)."""
    fresh = incoming if order is None else first_per_key(incoming, keys, order)
    return fresh.join(base.select(*keys), keys, "left_anti")


def new_demographics(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The older insert-only rule: a value counts as stored when its day matches."""
    keys = [*K.FOLLOWER_KEY[:-1], "collected_day"]
    day = F.to_date("date_collected").alias("collected_day")
    return insert_only(
        stored.select(*K.FOLLOWER_KEY[:-1], day), incoming.select("*", day), keys, "arrival"
    ).drop("collected_day").select(*incoming.columns)


def history_rows(posts: DataFrame, settings: Settings, observed: Column | None = None) -> DataFrame:
    """One snapshot row per post and day, from the incoming, not the merged, metrics."""
    rows = posts.select(
        F.lit(settings.company_id).alias("company_id") if "company_id" not in posts.columns else "company_id",
        "post_id",
        settings.now.alias("observed_at"),
        (settings.today if observed is None else observed).alias("observed_date"),
        "post_date",
        *[or_zero(F.col(m)).cast("bigint").alias(m) for m in K.METRICS],
        *[F.coalesce(F.col(r).cast("double"), F.lit(0.0)).alias(r) for r in _RATES],
        "arrival",
    )
    return last_per_key(rows, K.HISTORY_KEY).drop("arrival")


def needs_type(company_id: str | None = None) -> Column:
    """Stored under a distribution word or blank, of all companies or one."""
    affected = F.lower(F.coalesce("post_type", F.lit(""))).isin(K.RECLASSIFIED_TYPES)
    return affected if company_id is None else affected & (F.col("company_id") == company_id)


def reclassify(posts: DataFrame, settings: Settings, company_id: str | None = None) -> DataFrame:
    """Stored rows whose type is a distribution word or blank get a real type."""
    affected = needs_type(company_id)
    changed = {"post_type": F.when(affected, F.col("_new_type")).otherwise(F.col("post_type"))}
    if "updated_at" in posts.columns:
        changed["updated_at"] = F.when(affected, settings.now).otherwise(F.col("updated_at"))
    texts = [F.col(c) for c in ("post_content", "post_url", "post_title")]
    typed = with_post_type(posts, F.col("post_type"), *texts, name="_new_type")
    return typed.withColumns(changed).drop("_new_type")


# --- changes on stored tables ------------------------------------------------------------
# Rows carry ``change_no`` (0 in the base, then the number of the version that brought them), ``kind`` ("base",
# "merge", "set" or "drop") and ``supplied``, the columns that a change brings. A key has one row per change.


def without_dropped(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that came after their key was last dropped."""
    gone = rows.where("kind = 'drop'").groupBy(*keys).agg(F.max("change_no").alias("gone"))
    kept = rows.where("kind <> 'drop'").join(gone, keys, "left")
    return kept.where(F.col("gone").isNull() | (F.col("change_no") > F.col("gone"))).drop("gone")


def _last(columns: list[str], partial: set[str], order: Column) -> tuple[list[Column], list[str]]:
    """The last value of each column, and what to select of it; those that some changes lack come from the last change that
    has them. The bulky texts of a row are kept apart, so who selects none of them neither reads nor moves them."""
    whole = [c for c in columns if c not in partial]
    groups = {"kept": [c for c in whole if c not in K.BULKY_COLUMNS], "texts": [c for c in whole if c in K.BULKY_COLUMNS]}
    there = {c: F.when((F.col("kind") == "base") | F.array_contains("supplied", c), order) for c in partial}
    aggregates = [
        *[F.max_by(F.struct(*names), order).alias(group) for group, names in groups.items() if names],
        *[F.max_by(F.struct(c), there[c])[c].alias(c) for c in columns if c in partial],
    ]
    return aggregates, [*[f"{group}.*" for group, names in groups.items() if names], *[c for c in columns if c in partial]]


def fold_changes(rows: DataFrame, keys: list[str], partial: set[str]) -> DataFrame:
    """Last write wins on ``keys``."""
    columns = [c for c in rows.columns if c not in (*keys, "change_no", "kind", "supplied")]
    last, shown = _last(columns, partial - set(keys), F.col("change_no"))
    return rows.groupBy(*keys).agg(*last).select(*keys, *shown)


def fold_post_changes(rows: DataFrame, policy: str, partial: set[str]) -> DataFrame:
    """Posts under never-go-down (``max``) or last write wins (``new``), as one ``merge_posts`` per change would give.

    ``date_collected`` and ``created_at`` are those of the first row, ``updated_at`` that of the last if there
    are several. ``set`` rows change their columns only. The last row is the one of the latest ``exported_at``,
    then of the latest change; without export times changes follow each other as they were published.
    """
    merged = F.col("kind") != "set"
    metrics = K.METRICS if policy == "max" else []
    columns = [
        c for c in rows.columns
        if c not in (*K.POST_KEY, *_DB_COLUMNS, *metrics, "change_no", "kind", "supplied", "exported_at")
    ]
    first = {
        c: F.min_by(F.col(c), F.when(F.col(c).isNotNull() & merged, F.col("change_no"))) for c in ("date_collected", "created_at")
    }
    single = F.count_if(merged) == 1
    last, shown = _last(columns, partial & set(columns), F.struct("exported_at", "change_no"))
    folded = rows.groupBy(*K.POST_KEY).agg(
        *last,
        *[F.when(single, F.max(m)).otherwise(F.max(or_zero(F.col(m)))).alias(m) for m in metrics],
        *[c.alias(n) for n, c in first.items()],
        F.when(F.count("*") > 1, F.max_by("updated_at", "change_no"))
        .otherwise(F.max(F.when(F.col("kind") == "base", F.col("updated_at")))).alias("updated_at"),
        F.count_if(merged).alias("copies"),
        F.max("exported_at").alias("exported_at"),
    )
    out = folded.select(*K.POST_KEY, *shown, *metrics, *_DB_COLUMNS, "copies", "exported_at")
    if policy == "max":
        fresh = recomputed_rates()
        out = out.withColumns({r: F.when(F.col("copies") > 1, fresh[r]).otherwise(F.col(r)) for r in _RATES})
    return out
