"""Row counts, labels, samples and look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from txclean.operators.dedup import repeat_rows
from txclean.shared import shared_table


def row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One row (stage, rows) per named DataFrame."""
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
            for name, df in stages.items()
        ),
    )


def explode_labels(df: DataFrame, col: str, sep: str = ";", out: str = "label") -> DataFrame:
    """One row per label of a `sep`-joined list; rows without labels drop out."""
    return df.where(F.col(col) != "").withColumn(
        out, F.explode(F.split(col, rf"\Q{sep}\E"))
    )


def label_profile(df: DataFrame, col: str, sep: str = ";") -> DataFrame:
    return explode_labels(df, col, sep).groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


#: Columns that one number tells apart.
BITS = 63
#: Hexadecimal digits that a histogram tells apart, and all digits of a row's place.
DIGITS, ALL_DIGITS = 4, 8 + 64


def sample_rows(
    df: DataFrame,
    fraction: float,
    by: Sequence[str] | None = None,
    seed: int = 1,
    small: int = 50_000,
) -> DataFrame:
    """A sample without replacement of exactly round(fraction x rows) rows.

    The rows with the smallest hash of `by` (columns which identify a row; all by
    default) and seed are taken, those with equal hashes in the order of a digest of the
    whole row. The last one taken is found by selection and not by sorting: a histogram over
    the first digits tells which range it is in, the next one over the following
    digits of that range alone, until no more than `small` different places are left. Copies
    of a row have one place and count by their number, so `by` may have one value on any
    share of the rows. Histograms have 65,536 bins at most.
    """
    columns = df.columns
    hashed = df.withColumn("__hash", sample_hash(by or columns, seed)).withColumn(
        "__range", F.shiftright("__hash", 16)
    )
    wanted = F.round(F.lit(fraction) * F.sum("held").over(Window.partitionBy())).cast("long")
    bins = hashed.groupBy("__range").agg(F.count(F.lit(1)).alias("held")).withColumn("wanted", wanted)
    edge = _edge(bins.where("wanted > 0"), "__range", F.col("wanted"))
    if edge is None:
        return df.where(F.lit(False))
    # The place of a row: its hash, then the digest, as hexadecimal digits of one length.
    values = (_without_maps(F.col(f.name), f.dataType).alias(f.name) for f in df.schema)
    digest = F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)
    place = F.concat(F.lower(F.lpad(F.hex("__hash"), 8, "0")), digest)
    first = edge["at"]
    in_range = hashed.where(F.col("__range") == first)
    places = in_range.groupBy(place.alias("__place")).agg(F.count(F.lit(1)).alias("held"))
    prefix, missing, held = f"{first:04x}", edge["missing"], edge["held"]
    if held > small:
        places = shared_table(places, "sample-edge")
    while held > small and len(prefix) < ALL_DIGITS:
        digits = F.substring("__place", len(prefix) + 1, DIGITS)
        bins = places.where(F.col("__place").startswith(prefix)).groupBy(digits.alias("at")).agg(F.sum("held").alias("held"))
        edge = _edge(bins, "at", F.lit(missing))
        prefix, missing, held = prefix + edge["at"], edge["missing"], edge["held"]
    last = _edge(places.where(F.col("__place").startswith(prefix)), "__place", F.lit(missing))
    upto = place < last["at"] if last["missing"] < last["held"] else place <= last["at"]
    taken = hashed.where((F.col("__range") < first) | ((F.col("__range") == first) & upto)).select(*columns)
    if last["missing"] == last["held"]:
        return taken
    # All rows at the last place are copies of one, and a part of them is taken.
    one = in_range.where(place == last["at"]).select(*columns).limit(1)
    return taken.unionByName(repeat_rows(one, F.lit(last["missing"])))


def _edge(bins: DataFrame, at: str, wanted: Column):
    """The bin (at, held, missing) with which `wanted` rows are reached; `missing` of it are."""
    upto = Window.orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        bins.withColumn("upto", F.sum("held").over(upto))
        .select(F.col(at).alias("at"), "held", "upto", wanted.alias("wanted"))
        .where("upto >= wanted")
        .orderBy("at")
        .select("at", "held", (F.col("wanted") - F.col("upto") + F.col("held")).alias("missing"))
        .first()
    )


def _without_maps(value: Column, kind: DataType) -> Column:
    """The value with each map as its sorted entries, so that equal maps give equal texts."""
    if isinstance(kind, MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _without_maps(e["key"], kind.keyType).alias("key"),
                _without_maps(e["value"], kind.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda e: _without_maps(e, kind.elementType))
    if isinstance(kind, StructType):
        fields = (_without_maps(value[f.name], f.dataType).alias(f.name) for f in kind)
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def sample_hash(by: Sequence[str], seed: int) -> Column:
    """32 bits of the MD5 of the seed and the columns, as a long."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def inject_copies(
    df: DataFrame, fraction: float, by: Sequence[str] | None = None, seed: int = 1
) -> DataFrame:
    """The rows and, a second time, a sample of them."""
    return df.unionByName(sample_rows(df, fraction, by, seed))


def enrich(
    df: DataFrame, ref: DataFrame, on: str | Sequence[str], repeated: str = "fail"
) -> DataFrame:
    """Add the columns of a reference relation by key; no match gives nulls, and every row
    stays one row.

    If the reference has keys more than once, `fail` raises an error that names one when
    the result is read, `first` takes the least row of a key in the order of its columns, and
    `all` joins every row of the key. Null keys match nothing. The reference's size decides
    between broadcast and shuffle.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if repeated not in ("fail", "first", "all"):
        raise ValueError(f"unknown way {repeated!r}")
    others = [c for c in ref.columns if c not in keys]
    if repeated == "all":
        return df.join(ref, on, "left")
    known = ref.dropna(subset=keys)
    if not others:
        return df.join(known.distinct(), on, "left")
    row = F.struct(*others)
    if repeated == "first":
        least = known.groupBy(*keys).agg(F.min(row).alias("__row"))
    else:
        counted = known.groupBy(*keys).agg(F.first(row).alias("__row"), F.count(F.lit(1)).alias("__rows"))
        message = F.concat(
            F.lit(f"the reference has {', '.join(keys)} more than once: "), F.to_json(F.struct(*keys))
        )
        least = counted.withColumn(
            "__row", F.when(F.col("__rows") > 1, F.raise_error(message)).otherwise(F.col("__row"))
        )
    return df.join(least.select(*keys, "__row.*"), on, "left")


def unmatched(df: DataFrame, ref: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose values in `on` do not occur together in the reference relation."""
    return df.join(ref.select(*on).distinct(), list(on), "left_anti")


def functional_dependency(
    df: DataFrame, determinant: Sequence[str], dependent: Sequence[str]
) -> DataFrame:
    """Where `determinant` doesn't determine `dependent`: one row per broken value of the
    determinant, with the number of different dependent values, the rows, and the least
    and greatest dependent value as witnesses. Nulls are values like any other.

    Rows are counted by both before a determinant is looked at, so one that a large share of the
    rows has costs no more than its different values.
    """
    determinant, dependent = list(determinant), list(dependent)
    value = F.struct(*dependent)
    counted = df.groupBy(*determinant, *dependent).agg(F.count(F.lit(1)).alias("__rows"))
    return (
        counted.groupBy(*determinant)
        .agg(
            F.count(F.lit(1)).alias("values"),
            F.sum("__rows").alias("rows"),
            F.min(value).alias("least"),
            F.max(value).alias("greatest"),
        )
        .where("values > 1")
    )


def inclusion_dependencies(columns: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows (included, within, values): every value of the one column stands in the other.

    `columns` maps names to (frame, column). All values meet in one grouping, as text, each with
    the columns that hold it as bits of numbers, which tasks put together before the shuffle; from
    how often each set comes the pairs are counted. So no column is compared with another.
    Nulls don't count; an empty column is in none.
    """
    words = [f"held_{n}" for n in range(-(-len(columns) // BITS))]
    values = reduce(
        DataFrame.unionByName,
        (
            df.where(F.col(col).isNotNull()).select(
                F.col(col).cast("string").alias("value"),
                *(F.lit(1 << at % BITS if n == at // BITS else 0).cast("long").alias(w) for n, w in enumerate(words)),
            )
            for at, (df, col) in enumerate(columns.values())
        ),
    )
    names = (
        F.when(F.col(words[at // BITS]).bitwiseAND(F.lit(1 << at % BITS).cast("long")) != 0, F.lit(name))
        for at, name in enumerate(columns)
    )
    sets = (
        values.groupBy("value")
        .agg(*(F.bit_or(w).alias(w) for w in words))
        .groupBy(*words)
        .agg(F.count(F.lit(1)).alias("held"))
        .select(F.array_compact(F.array(*names)).alias("names"), "held")
    )
    pairs = (
        sets.select("names", "held", F.explode("names").alias("included"))
        .select("included", "held", F.explode("names").alias("within"))
        .groupBy("included", "within")
        .agg(F.sum("held").alias("values"))
    )
    own = pairs.where("included = within").select(F.col("included").alias("name"), F.col("values").alias("own"))
    found = pairs.where("included <> within").join(own, F.col("included") == F.col("name"))
    return found.where(F.col("values") == F.col("own")).select("included", "within", "values")
