"""Key operators: first-match lookup, append-if-absent, membership, parents.

No side is broadcast by hint.  The planner broadcasts a side whose estimated or
measured size is below its threshold, and otherwise shuffles both sides and splits
hot partitions at run time.  Dimensions are reduced to one row per key before the
join (partial aggregation, constant state per key), so neither duplicate keys nor a
hot dimension key can multiply or pile up rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.session import cut_lineage, shuffle_partitions

_KEY = "__key"
_NO_KEY = "__no_key"
_FOUND = "__found"


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name where null equals null; one copy of each key."""
    renamed = right.withColumnsRenamed({key: f"__r_{key}" for key in keys})
    condition = F.lit(True) if not keys else None
    for key in keys:
        same = left[key].eqNullSafe(renamed[f"__r_{key}"])
        condition = same if condition is None else condition & same
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__r_{key}" for key in keys])


def _pick(values: Mapping[str, str], order: Sequence[str], latest: bool) -> list[Column]:
    """Aggregates giving the value of the first row in ``order`` (or the last), nulls kept.

    With one order column every value has an aggregate of its own, and those of plain
    numbers are combined in hash maps; several order columns need a struct.
    """
    by = F.max_by if latest else F.min_by
    if len(order) == 1:
        end = F.max if latest else F.min
        return [
            (end(column) if column == order[0] else by(column, order[0])).alias(out) for out, column in values.items()
        ]
    row = by(F.struct(*[F.col(c).alias(o) for o, c in values.items()]), F.struct(*order))
    return [row.alias(_FOUND)]


def _common(left: T.DataType, right: T.DataType) -> T.DataType:
    if left == right:
        return left
    if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
        return T.LongType()
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def _flat(column: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A key as (value without nulls, is it missing), on which null equals null.

    Grouping and joining on these two plain columns share one partitioning, and sorts
    can compare by prefix.
    """
    value = column.cast(kind)
    if isinstance(kind, T.StringType):
        filler = F.lit("")
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        filler = F.lit("1970-01-01").cast(kind)
    else:
        filler = F.lit(0).cast(kind)
    return F.coalesce(value, filler), value.isNull()


def _kind(df: DataFrame, column: Column) -> T.DataType:
    return df.select(column).schema[0].dataType


def first_per_key(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str], latest: bool = False
) -> DataFrame:
    """One row per key: the first in ``order``, or the last.  A null value of that row is kept."""
    reduced = df.groupBy(*keys).agg(*_pick({v: v for v in values}, order, latest))
    return reduced if len(order) == 1 else reduced.select(*keys, *[F.col(f"{_FOUND}.{v}").alias(v) for v in values])


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str | Column,
    dim_key: str | Column,
    values: Mapping[str, str],
    order: Sequence[str],
    salts: int = 0,
    latest: bool = False,
    hot: str | None = None,
) -> DataFrame:
    """Add ``values`` (new name -> dimension column) of the first dimension row with the key.

    The row count of ``df`` never changes, and a null key finds a null key.  ``order`` must
    not be null.  ``salts``
    spreads a known hot key of ``df`` by hash of the row over that many copies of the
    reduced dimension; without it hot partitions are split at run time.  ``hot`` names one text
    that very many rows have as key: only they are spread, and only its dimension row is copied.
    """
    key = F.col(key) if isinstance(key, str) else key
    dim_key = F.col(dim_key) if isinstance(dim_key, str) else dim_key
    kind = _common(_kind(df, key), _kind(dim, dim_key))
    wanted = {out: f"__v{i}" for i, out in enumerate(values)}
    ordered = [f"__o{i}" for i in range(len(order))]
    value, missing = _flat(dim_key, kind)
    source = dim.select(
        value.alias(_KEY),
        missing.alias(_NO_KEY),
        *[F.col(column).alias(wanted[out]) for out, column in values.items()],
        *[F.col(column).alias(ordered[i]) for i, column in enumerate(order)],
    )
    inner = {name: ordered[order.index(values[out])] if values[out] in order else name for out, name in wanted.items()}
    reduced = source.groupBy(_KEY, _NO_KEY).agg(*_pick(inner, ordered, latest))
    if len(order) > 1:
        reduced = reduced.select(_KEY, _NO_KEY, *[F.col(f"{_FOUND}.{name}").alias(name) for name in wanted.values()])
    return _attach(df, reduced, _flat(key, kind), wanted, salts, hot)


def _attach(
    df: DataFrame, reduced: DataFrame, key: tuple[Column, Column], wanted: Mapping[str, str], salts: int, hot: str | None = None
) -> DataFrame:
    """Left join of one row per key; ``reduced`` is partitioned as the join wants it."""
    left = df.withColumns({"__lk": key[0], "__lm": key[1]})
    condition = (F.col("__lk") == F.col(_KEY)) & (F.col("__lm") == F.col(_NO_KEY))
    if hot is not None and salts <= 1:
        salts = shuffle_partitions(df.sparkSession)
    if salts > 1:
        salt, copies = F.pmod(F.xxhash64(*df.columns), F.lit(salts)), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
        if hot is not None:
            salt = F.when(F.col("__lk") == hot, salt).otherwise(F.lit(0).cast("long"))
            copies = F.when(F.col(_KEY) == hot, copies).otherwise(F.array(F.lit(0).cast("long")))
        left = left.withColumn("__salt", salt)
        reduced = reduced.withColumn("__dsalt", F.explode(copies))
        condition = condition & (F.col("__salt") == F.col("__dsalt"))
    joined = left.join(reduced, condition, "left")
    replaced = {out.lower() for out in wanted}
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in replaced]
    return joined.select(*kept, *[F.col(inner).alias(out) for out, inner in wanted.items()])


def lookup_fallback(
    df: DataFrame,
    dim: DataFrame,
    key: str | Column,
    dim_keys: Sequence[str],
    value: str,
    out: str,
    order: Sequence[str],
) -> DataFrame:
    """Look one key up in several dimension columns, in order, until a value is found.

    The columns are stacked with their priority and reduced together, so the large
    side is joined once however many fall-backs there are.
    """
    key = F.col(key) if isinstance(key, str) else key
    ordered = [f"__o{i}" for i in range(len(order))]
    columns = F.array(
        *[
            F.struct(F.lit(rank).alias("rank"), F.col(column).cast("string").alias("k"))
            for rank, column in enumerate(dim_keys)
        ]
    )
    stacked = dim.select(
        F.explode(columns).alias("s"), F.col(value).alias("__value"), *[F.col(c).alias(o) for o, c in zip(ordered, order)]
    )
    plain, missing = _flat(F.col("s.k"), T.StringType())
    source = stacked.select(
        plain.alias(_KEY), missing.alias(_NO_KEY), F.col("s.rank").alias("__rank"), "__value", *ordered
    )
    inner = {"__v": ordered[order.index(value)] if value in order else "__value"}
    first = source.groupBy(_KEY, _NO_KEY, "__rank").agg(*_pick(inner, ordered, False))
    found = F.col("__v") if len(order) == 1 else F.col(f"{_FOUND}.__v")
    reduced = (
        first.withColumn("__v", found)
        .where(F.col("__v").isNotNull())
        .groupBy(_KEY, _NO_KEY)
        .agg(F.min_by("__v", "__rank").alias("__v0"))
    )
    return _attach(df, reduced, _flat(key, T.StringType()), {out: "__v0"}, 0)


def lookup_any_of(
    df: DataFrame,
    dim: DataFrame,
    keys: Sequence[str | Column],
    dim_key: str,
    values: Mapping[str, str],
    order: Sequence[str],
    latest: bool = False,
) -> DataFrame:
    """Look several left keys up in one dimension column; each value takes the first hit.

    All values travel in one struct, so several targets cost one join per key.
    """
    outs = list(values)
    for rank, key in enumerate(keys):
        df = lookup(df, dim, key, dim_key, {f"__{rank}_{out}": values[out] for out in outs}, order, latest=latest)
    found = {out: F.coalesce(*[F.col(f"__{rank}_{out}") for rank in range(len(keys))]) for out in outs}
    dropped = [f"__{rank}_{out}" for rank in range(len(keys)) for out in outs]
    return df.withColumns(found).drop(*dropped)


def lookup_rekey(df, dim, key: str, alternative: Column, dim_key: str, value: str, out: str, order) -> DataFrame:
    """Look up by ``key``; on a miss by a rewritten key."""
    return lookup_any_of(df, dim, [key, alternative], dim_key, {out: value}, order)


def lookup_or_default(df, dim, key: str, default: str, dim_key: str, values: Mapping[str, str], order) -> DataFrame:
    """A missing key finds the dimension row named ``default``.

    Most keys may be missing, and the reduced side of the join keeps a hot partition from being split at
    run time, so the rows of the default are spread.
    """
    return lookup(df, dim, F.coalesce(F.col(key), F.lit(default)), dim_key, values, order, hot=default)


def only_new(df: DataFrame, existing: DataFrame, keys: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``existing``; null equals null."""
    return _by_membership(df, existing, keys, "left_anti")


def only_known(df: DataFrame, known: DataFrame, keys: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``known``; null equals null."""
    return _by_membership(df, known, keys, "left_semi")


def _by_membership(df: DataFrame, other: DataFrame, keys: Mapping[str, str] | Sequence[str], how: str) -> DataFrame:
    """Semi- or anti-join on the distinct keys of the other side.

    Making them distinct combines a hot stored key before the shuffle, and its exchange
    is the one the join needs.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {key: key for key in keys}
    mine, theirs, condition = {}, [], F.lit(True)
    for i, (left, right) in enumerate(pairs.items()):
        kind = _common(_kind(df, F.col(left)), _kind(other, F.col(right)))
        mine[f"__k{i}"], mine[f"__m{i}"] = _flat(F.col(left), kind)
        value, missing = _flat(F.col(right), kind)
        theirs += [value.alias(f"__e{i}"), missing.alias(f"__f{i}")]
        same = (F.col(f"__k{i}") == F.col(f"__e{i}")) & (F.col(f"__m{i}") == F.col(f"__f{i}"))
        condition = same if i == 0 else condition & same
    stored = other.select(*theirs).distinct()
    return df.withColumns(mine).join(stored, condition, how).drop(*mine)


def complete_rows(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split into rows with every key part and rows lacking one (the rejects)."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.where(~missing), df.where(missing)


def denormalise(fact: DataFrame, dims: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Full outer joins ``(fact column, suffix for clashing names, dim with id)``.

    The fact is left-joined with all dimensions in one chain, and the rows that only a dimension
    has follow it, so the plan grows by one join and one anti-join per dimension.  The keys in use are
    found for all dimensions together, in one aggregated read of the fact's key columns.

    The key keeps the value of either side, and null equals null as in the lookups: a
    fact row without a key takes a dimension row without an id.  A row that only a dimension has
    asks for nothing in the others.
    """
    columns = [column for column, _, _ in dims]
    used = fact.groupingSets([[c] for c in dict.fromkeys(columns)], *dict.fromkeys(columns)).agg(
        *[F.grouping(c).alias(f"__g_{c}") for c in dict.fromkeys(columns)]
    )
    used = cut_lineage(used)
    result, only_dims = fact, []
    for column, suffix, dim in dims:
        renamed = dim.withColumnsRenamed(
            {name: f"{name}{suffix}" for name in dim.columns if name != "id" and name in result.columns}
        ).withColumnRenamed("id", "__id")
        kind = _common(_kind(result, F.col(column)), _kind(renamed, F.col("__id")))
        value, missing = _flat(F.col(column), kind)
        other, absent = _flat(F.col("__id"), kind)
        left = result.withColumns({"__k": value, "__m": missing})
        right = renamed.withColumns({"__e": other, "__f": absent})
        same = (F.col("__k") == F.col("__e")) & (F.col("__m") == F.col("__f"))
        keys_in_use = used.where(F.col(f"__g_{column}") == 0).select(column)
        only_dims.append(only_new(renamed, keys_in_use, {"__id": column}).withColumnRenamed("__id", column))
        result = left.join(right, same, "left").drop("__k", "__m", "__e", "__f", "__id")
    for rows in only_dims:
        result = result.unionByName(rows, allowMissingColumns=True)
    return result


def one_to_many(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """Left join that may multiply rows; the right key column is dropped."""
    renamed = right.withColumnRenamed(right_key, "__many")
    return left.join(renamed, F.col(key) == F.col("__many"), "left").drop("__many")


def parent_key(df: DataFrame, candidates: Sequence[str], out: str = "parent_key", required: bool = False) -> DataFrame:
    """The parent by precedence; rows without one are dropped when it is required."""
    chosen = df.withColumn(out, F.coalesce(*[F.col(column) for column in candidates]))
    return chosen.where(F.col(out).isNotNull()) if required else chosen


def resolve_parent(
    entities: DataFrame,
    parent: str,
    identifier: str = "general_identifier",
    out: str = "entityparent_id",
    source: DataFrame | None = None,
) -> DataFrame:
    """Parent identifier to the id of the row that carries it, null when unknown."""
    return lookup(entities, entities if source is None else source, parent, identifier, {out: "id"}, ["id"])
