"""Social-media post exports: landed API pages -> one typed row per post.

The original fetched pages over HTTP and reshaped them with pandas, row by
row.  Here the pages are a landed JSON/parquet table (``data.posts`` array per
page) and every step is a column expression over the whole table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.columns import as_of_date

# fixed values: the four base columns and the per-network profile key used
# when old rows are deleted
BASE_COLUMNS = ("profile_id", "created_time", "content_type", "network")
PROFILE_COLUMN = {"facebook": "facebook_profileId", "instagram": "instagram_profileId",
                  "tiktok": "profile_id", "youtube": "profile_id"}
REACTIONS_COLUMN = "facebook_reactions_by_type"
MAX_KEYS = 10_000  # distinct names that become columns


def distinct_names(names: DataFrame) -> list[str]:
    """The distinct values of a one-column frame; more than ``MAX_KEYS`` cannot be columns and raise."""
    found = [r[0] for r in names.distinct().orderBy(1).limit(MAX_KEYS + 1).collect()]
    if len(found) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} distinct names")
    return found


def post_label_names(labels: Column) -> Column:
    """Non-empty label names joined with ", " (P02)."""
    names = F.transform(labels, lambda x: x.getField("name"))
    return F.array_join(F.filter(names, lambda n: n.isNotNull() & (n != "")), ", ")


def posts_from_pages(pages: DataFrame, network: str) -> DataFrame:
    """One row per post out of ``data.posts`` page payloads.

    ``profile_id`` comes from ``authorId``; ``post_labels_names`` is added
    when posts carry ``post_labels``; every other post field is kept.
    """
    posts = pages.select(F.explode("data.posts").alias("_p")).select("_p.*")
    fields = posts.columns
    get = lambda f: F.col(f) if f in fields else F.lit(None).cast("string")
    out = [get("authorId").alias("profile_id"), get("created_time").alias("created_time"),
           get("content_type").alias("content_type"), F.lit(network).alias("network")]
    if "post_labels" in fields:
        out.append(post_label_names(F.col("post_labels")).alias("post_labels_names"))
    out += [F.col(f"`{f}`") for f in fields if f not in ("authorId", "created_time", "content_type")]
    return posts.select(*out)


def coerce_numeric(df: DataFrame, prefix: str = "insights_") -> DataFrame:
    """Prefixed columns as numbers, unparsable or missing -> 0."""
    repl = {}
    for f in df.schema.fields:
        if not f.name.startswith(prefix):
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.NumericType):
            v = c.cast("double")
            repl[f.name] = F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0))
        else:
            repl[f.name] = F.coalesce(F.nanvl(c.try_cast("double"), F.lit(0.0)), F.lit(0.0))
    return df.withColumns(repl) if repl else df


def prefix_columns(df: DataFrame, network: str) -> DataFrame:
    """Prefix every column with the network except the base columns."""
    renames = {c: f"{network}_{c}" for c in df.columns
               if not c.startswith(f"{network}_") and c not in BASE_COLUMNS}
    return df.withColumnsRenamed(renames)


def expand_struct_columns(df: DataFrame, network: str, reaction_keys: Iterable[str] | None = None) -> DataFrame:
    """Reaction counts -> ``facebook_reaction_<k>`` columns; attachment
    objects -> ``<network>_attachment_<field>`` columns (P05).

    Map-typed reactions need their keys: pass ``reaction_keys`` (a key that is
    not listed fails the job, so no count is lost) or they are discovered with
    one distinct-keys job, of at most ``MAX_KEYS`` names.  Attachment *lists* are left for
    :func:`stringify_complex`, as in the original.  The original gave every
    attachment field the same name; fields get a suffix here.
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    if REACTIONS_COLUMN in schema:
        t = schema[REACTIONS_COLUMN]
        rc = F.col(REACTIONS_COLUMN)
        if isinstance(t, T.StructType):
            new = [rc.getField(f.name).alias(f"facebook_reaction_{f.name}") for f in t.fields]
        elif isinstance(t, T.MapType):
            keys = list(reaction_keys) if reaction_keys is not None else distinct_names(
                df.select(F.explode(F.map_keys(rc))))
            unlisted = F.array_except(F.map_keys(rc), F.array(*map(F.lit, keys)).cast("array<string>"))
            known = F.when(F.size(unlisted) > 0, F.raise_error(F.concat(
                F.lit("reaction_keys lacks "), F.array_join(unlisted, ", "))).cast(t)).otherwise(rc)
            new = [F.try_element_at(known, F.lit(k)).alias(f"facebook_reaction_{k}") for k in keys]
        else:
            new = []
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if c != REACTIONS_COLUMN], *new)
        schema = {f.name: f.dataType for f in df.schema.fields}
    attachment = [c for c in df.columns if "attachment" in c]
    structs = [c for c in attachment if isinstance(schema[c], T.StructType)]
    if structs:
        new = [F.col(f"`{c}`").getField(f.name).alias(f"{network}_attachment_{f.name}")
               for c in structs for f in schema[c].fields]
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in attachment], *new)
    return df


# JSON text keeps null fields, as a JSON dump of the record would
JSON_OPTIONS = {"ignoreNullFields": "false"}


def _text(c: Column, t: T.DataType) -> Column:
    if isinstance(t, (T.StructType, T.MapType)):
        return F.to_json(c, JSON_OPTIONS)
    if isinstance(t, T.ArrayType):
        return F.array_join(F.transform(c, lambda x: _text(x, t.elementType)), ", ")
    return c.cast("string")


def stringify_complex(df: DataFrame) -> DataFrame:
    """Lists -> ", "-joined text, objects -> JSON, missing text -> '' (P06).

    Numbers and dates keep their type (pandas only touched object columns).
    List items that are booleans become ``true`` / ``false``, null items are left
    out, and JSON text keeps non-ASCII characters as they are.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType, T.StringType)):
            c = F.coalesce(_text(c, f.dataType), F.lit(""))
        out.append(c.alias(f.name))
    return df.select(*out)


def _created_date(df: DataFrame) -> Column:
    t = df.schema["created_time"].dataType
    c = F.col("created_time")
    return c.cast("date") if not isinstance(t, T.StringType) else F.to_date(F.try_to_timestamp(c))


def replace_profile_window(existing: DataFrame, new: DataFrame, *, network: str | None = None,
                           profile_col: str | None = None, start=None, end=None, as_of=None,
                           days: int = 14) -> DataFrame:
    """Full replacement table: for every profile present in ``new``, drop the
    existing rows whose ``created_time`` date lies in ``[start, end]``
    (default: the last ``days`` days up to ``as_of``), then append ``new``
    (P07).  Networks without a known profile key delete nothing.

    The result is computed in one plan; write it to a new location (see
    :mod:`tillsight.sources.sinks`) rather than over the table being read.
    """
    key = profile_col or PROFILE_COLUMN.get(network or "")
    if key is None:
        return existing.unionByName(new, allowMissingColumns=True)
    hi = as_of_date(end if end is not None else as_of)
    lo = as_of_date(start) if start is not None else F.date_sub(hi, days)
    profiles = new.select(F.col(key).alias("_profile")).distinct()
    d = _created_date(existing)
    inside = F.coalesce((d >= lo) & (d <= hi), F.lit(False))
    # rows outside the window pass through; only the window's slice is joined
    slice_ = existing.where(inside)
    kept = slice_.join(profiles, slice_[key] == profiles["_profile"], "left_anti")
    return existing.where(~inside).unionByName(kept).unionByName(new, allowMissingColumns=True)


def export_posts(pages: DataFrame, network: str, reaction_keys: Iterable[str] | None = None) -> DataFrame:
    """P01 -> P03 -> P04 -> P05 -> P06 as one lazy plan (the export job)."""
    df = posts_from_pages(pages, network)
    df = coerce_numeric(df)
    df = prefix_columns(df, network)
    df = expand_struct_columns(df, network, reaction_keys)
    return stringify_complex(df)

