"""Loading association tables, one or many files, as one lazy DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocframe import labels as L
from assocframe.functions.scalars import neg_log10_floor, odds_ratio
from assocframe.operators.sampling import sample_exact, sample_key, sample_proportional
from assocframe.roles import MissingRole, Roles, canonical_names, col, resolve_roles, to_double, to_long
from assocframe.sources.files import headers

MODES = ("full", "gwas", "sample")


@dataclass(frozen=True)
class Loaded:
    """A loaded table: canonical column names, the roles found, the mode really used."""

    df: DataFrame
    roles: Roles
    mode: str
    sampled: bool = False
    fallback_files: tuple[str, ...] = ()


def scan(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Lazy Parquet scan; with ``columns`` only those are read."""
    df = spark.read.option("mergeSchema", "true").parquet(
        *([paths] if isinstance(paths, str) else paths)
    )
    return df.select(*[col(c) for c in columns]) if columns is not None else df


def scan_roles(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scan of the role columns only."""
    df = scan(spark, paths)
    return df.select(*[col(c) for c in resolve_roles(df.columns).columns()])


def clean(df: DataFrame, roles: Roles, with_file: bool = False, settle: bool = False) -> DataFrame:
    """Canonical names and types: NaN is NULL, chromosome and id are text, position is a long.

    ``settle`` adds the odds ratio and the effect to show by the roles of this table.
    """
    numbers = {roles.pval, roles.maf, roles.info, roles.se, roles.or_effect, roles.direct_or}
    texts = {roles.chr, roles.snp, roles.disorder, roles.effect_kind}
    renames = canonical_names(roles)
    out = []
    for field in df.schema.fields:
        c = col(field.name)
        if field.name == roles.pos:
            c = c.cast("bigint") if isinstance(field.dataType, T.IntegralType) else to_long(c)
        elif field.name in numbers or isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            c = to_double(c)
        elif field.name in texts:
            c = c.cast("string")
        out.append(c.alias(renames.get(field.name, field.name)))
    if settle and (roles.or_effect or roles.direct_or):
        number = lambda name: to_double(col(name)) if name is not None else None
        kind = col(roles.effect_kind).cast("string") if roles.effect_kind is not None else None
        out.append(odds_ratio(number(roles.or_effect), kind, number(roles.direct_or)).alias("settled_or"))
    if settle and roles.effect is not None:
        out.append(to_double(col(roles.effect)).alias("shown_effect"))
    if with_file:
        out.append(F.col("_metadata.file_name").alias("source_file"))
    return df.select(*out)


def significant(df: DataFrame, level: float = L.GENOME_WIDE, roles: Roles | None = None) -> DataFrame:
    """``p < level`` on the bare column, so the scan can skip row groups by statistics."""
    r = roles if roles is not None else resolve_roles(df.columns)
    r.need("pval")
    return df.filter(col(r.pval) < F.lit(level))


def load(
    spark: SparkSession,
    paths: str | Sequence[str],
    mode: str = "full",
    cap: int | None = None,
    columns: Sequence[str] | None = None,
    level: float | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
) -> Loaded:
    """Load Parquet files of any headers as one table with canonical names.

    ``full`` reads all rows.  ``gwas`` keeps genome-wide significant rows; files
    without a p-value column are loaded whole and named in ``fallback_files``.
    ``sample`` takes ``cap`` rows; ``key`` names columns that identify a row, by
    default disorder, id and position.  ``level`` adds a p-value filter that
    reaches the scan in every mode.

    Files with the same header (names and types) share one scan; each header
    gets its own roles.  Where files state their effects differently, what
    depends on a file's roles is settled before the files are united: the odds
    ratio (``settled_or``) and the effect to show (``shown_effect``).  A column whose types differ becomes a
    double if all are numbers, else text.
    """
    _check_mode(mode, cap)
    found = headers(spark, paths)
    settle = len({_effect_rule(resolve_roles(schema.names)) for schema, _ in found}) > 1
    parts, fallback, effective = [], [], []
    for schema, files in found:
        roles = resolve_roles(schema.names)
        part = spark.read.parquet(*files)
        part_mode = mode
        if mode == "gwas":
            if roles.pval is None:
                part_mode = "full"
                fallback += [f.rsplit("/", 1)[-1] for f in files]
            else:
                part = significant(part, L.GENOME_WIDE, roles)
        if level is not None and roles.pval is not None:
            part = significant(part, level, roles)
        parts.append(clean(part, roles, with_file=True, settle=settle))
        effective.append(part_mode)
    df = unite(parts)
    if columns is not None:
        df = df.select(*[col(c) for c in columns], "source_file")
    if mode == "sample":
        df = sample_exact(df, cap, key or sample_key(df), seed)
    used = "full" if mode == "gwas" and set(effective) == {"full"} else mode
    return Loaded(df, resolve_roles(df.columns), used, mode == "sample", tuple(fallback))


def _effect_rule(roles: Roles) -> tuple:
    """What decides how a file's effects are read: which of the roles it has, and which one is shown."""
    has = [r is not None for r in (roles.or_effect, roles.effect_kind, roles.direct_or)]
    return (*has, roles.effect is None, roles.effect in (roles.or_effect, None), roles.effect in (roles.direct_or, None))


def _check_mode(mode: str, cap: int | None) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if (mode == "sample") != (cap is not None):
        raise ValueError("mode sample, and no other, takes a cap")


def unite(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column whose types differ becomes a double if all are numbers, else text."""
    kinds: dict[str, set] = {}
    for part in parts:
        for field in part.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType)
    common = {
        name: "double" if all(isinstance(t, T.NumericType) for t in types) else "string"
        for name, types in kinds.items()
        if len(types) > 1
    }
    cast = [
        part.select(*[col(c).cast(common[c]).alias(c) if c in common else col(c) for c in part.columns]) for part in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def load_plot_columns(
    spark: SparkSession,
    paths: str | Sequence[str],
    mode: str = "full",
    cap: int | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
) -> Loaded:
    """Chromosome, position, p, id and MAF of files of any headers, for a plot.

    Only those columns (and ``key``) are read.  ``sample`` takes about ``cap``
    rows, each block of each file giving its share.  Rows without a positive
    p-value are left out and ``neg_log10_p`` is added.
    """
    _check_mode(mode, cap)
    parts, used = [], []
    for schema, files in headers(spark, paths):
        r = resolve_roles(schema.names)
        wanted = [c for c in (r.chr, r.pos, r.pval, r.snp, r.maf) if c is not None]
        if not wanted:
            raise MissingRole("no column plays a known role")
        part = spark.read.parquet(*files)
        used.append("full" if mode == "gwas" and r.pval is None else mode)
        if used[-1] == "gwas":
            part = significant(part, L.GENOME_WIDE, r)
        # The key of a sample is matched by name and stays until the sample is drawn.
        keyed = [c for c in dict.fromkeys(key or ()) if c in part.columns and c not in wanted]
        renames = canonical_names(r)
        named = clean(part.select(*[col(c) for c in wanted], *[col(c) for c in keyed], *_place()), r)
        parts.append(named)
        key = [renames.get(k, k) for k in key] if key is not None else None
    df = unite(parts)
    names = [c for c in ("chr", "pos", "pval", "snp_id", "maf") if c in df.columns]
    if mode == "sample":
        df = sample_proportional(df, cap, ["_file", "_block"], key or [*names, "_file", "_block"], seed)
    out = df.select(*names)
    if "pval" in names:
        out = out.filter(col("pval") > 0).withColumn("neg_log10_p", neg_log10_floor(col("pval")))
    effective = "full" if mode == "gwas" and set(used) == {"full"} else mode
    return Loaded(out, resolve_roles(out.columns), effective, mode == "sample")


def _place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]


def block_sample(
    df: DataFrame, columns: Sequence[str], cap: int, key: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Proportional sample of a file scan, block by block."""
    keep = list(dict.fromkeys([*columns, *(key or [])]))
    placed = df.select(*[col(c) for c in keep], *_place())
    picked = sample_proportional(placed, cap, ["_file", "_block"], key or keep, seed)
    return picked.select(*[col(c) for c in columns])


def read_many(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Union of files of any schema by column name, with ``source_file``."""
    parts = []
    for schema, files in headers(spark, paths):
        part = spark.read.parquet(*files).select("*", F.col("_metadata.file_name").alias("source_file"))
        parts.append(part if columns is None else part.select(*[c for c in columns if c in schema.names], "source_file"))
    return unite(parts)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV export with a header, one file per partition."""
    df.write.mode(mode).option("header", "true").csv(path)


def to_pandas(df: DataFrame, n: int):
    """A small result for a plot: at most ``n`` rows reach the driver."""
    return df.limit(n).toPandas()
