"""Column roles: which column of a table is the p-value, the position, ...

Roles are resolved on the driver from the header alone, so no job runs.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted headers per role, first one present wins.  The first
# alias of a role is also its canonical name.
ALIASES: dict[str, tuple[str, ...]] = {
    "pval": ("pval", "p_value", "pvalue", "p.value", "p"),
    "maf": ("maf", "minor_af", "eaf"),
    "info": ("info", "info_score", "imputation_info"),
    "snp": ("snp_id", "snpid", "snp", "variant_id", "rsid", "rs_id", "raw_snp_id"),
    "chr": ("chr", "chrom", "chromosome", "#chr"),
    "pos": ("pos", "position", "bp", "basepair"),
    "effect": ("effect_size", "beta", "or", "effect", "b"),
    "se": ("se", "stderr", "standard_error"),
    "disorder": ("disorder", "phenotype", "trait", "disease", "condition"),
    "or_effect": ("effect_size", "beta", "b"),
    "effect_kind": ("effect_kind", "effect_type", "efecto_tipo"),
    "direct_or": ("or", "odds_ratio", "oddsratio"),
}

# Columns that loading adds where files of different headers are united: what each file's
# own roles said.  They go before all headers.
SETTLED = {"effect": "shown_effect", "settled_or": "settled_or"}

# The shorter alias lists of the p against MAF scatter view.
SCATTER_ALIASES: dict[str, tuple[str, ...]] = {
    "pval": ("pval", "palvalue", "pvalue"),
    "maf": ("maf",),
}


class MissingRole(ValueError):
    """An operator needs a role that no column of the table plays."""


@dataclass(frozen=True)
class Roles:
    """Actual column name per role, ``None`` when the table has none.

    ``effect`` is the effect shown in tables and may be a direct odds ratio;
    ``or_effect`` is the effect converted to an odds ratio and never is.
    """

    pval: str | None = None
    maf: str | None = None
    info: str | None = None
    snp: str | None = None
    chr: str | None = None
    pos: str | None = None
    effect: str | None = None
    se: str | None = None
    disorder: str | None = None
    or_effect: str | None = None
    effect_kind: str | None = None
    direct_or: str | None = None
    settled_or: str | None = None

    def need(self, *roles: str) -> None:
        missing = [r for r in roles if getattr(self, r) is None]
        if missing:
            raise MissingRole(f"no column plays the role(s): {', '.join(missing)}")

    def has(self, *roles: str) -> bool:
        return all(getattr(self, r) is not None for r in roles)

    def columns(self) -> list[str]:
        """Actual names of all role columns, each once, in role order."""
        found = (getattr(self, f.name) for f in fields(self))
        return list(dict.fromkeys(c for c in found if c is not None))


def pick(columns: Iterable[str], aliases: Iterable[str]) -> str | None:
    """First alias that is a column, ignoring case; of headers that differ in case only the last one counts."""
    order = {alias: place for place, alias in enumerate(aliases)}
    ranked = [(order[c.lower()], -place, c) for place, c in enumerate(columns) if c.lower() in order]
    return min(ranked)[2] if ranked else None


def resolve_roles(columns: Iterable[str]) -> Roles:
    columns = list(columns)
    found = {role: pick(columns, aliases) for role, aliases in ALIASES.items()}
    found |= {role: name for role, name in SETTLED.items() if name in columns}
    return Roles(**found)


def roles_of(df: DataFrame, roles: Roles | None = None) -> Roles:
    return roles if roles is not None else resolve_roles(df.columns)


def col(name: str) -> Column:
    """Column by exact name; headers such as ``p.value`` need the quoting."""
    return F.col("`" + name.replace("`", "``") + "`")


def canonical_names(roles: Roles) -> dict[str, str]:
    """Actual name -> canonical name, for the role columns that get renamed.

    A canonical name is the first alias of its role, so no other column can
    hold it already.
    """
    renames: dict[str, str] = {}
    for role, aliases in ALIASES.items():
        actual = getattr(roles, role)
        if actual is not None and role != "effect":
            renames[actual] = aliases[0]
    return renames


def canonicalize(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Rename role columns to canonical names; all other columns stay."""
    renames = canonical_names(roles_of(df, roles))
    return df.select(*[col(c).alias(renames.get(c, c)) for c in df.columns])


def to_double(column: Column) -> Column:
    """Numeric coercion: text that is no number becomes NULL, and so does NaN."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def to_long(column: Column) -> Column:
    """Whole number of a number or of text such as ``12`` or ``12.0``, else NULL."""
    return F.coalesce(column.try_cast("bigint"), to_double(column).try_cast("bigint"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    """Everything that is no number: text, boolean, date and time, nested."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))
    ]
