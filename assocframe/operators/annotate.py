"""Joining variants with user-supplied annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.functions.scalars import consequence_label, rsid_normal
from assocframe.plans.idfilter import could_match
from assocframe.plans.joins import lookup_join
from assocframe.plans.materialize import plan_bytes
from assocframe.roles import Roles, col, roles_of

# Shapes of the two kinds of JSON payload.
ASSOCIATIONS = (
    "struct<_embedded: struct<associations: array<struct<"
    "efoTraits: array<struct<trait: string>>, diseaseTrait: struct<trait: string>>>>>"
)


def trait_list(payload: Column) -> Column:
    """Distinct trait names of an association payload, sorted; empty when there are none."""
    associations = F.from_json(payload, ASSOCIATIONS).getField("_embedded").getField("associations")
    no_traits = F.array().cast("array<string>")
    per_association = F.transform(
        F.coalesce(associations, F.from_json(F.lit("[]"), "array<struct<efoTraits: array<struct<trait: string>>, diseaseTrait: struct<trait: string>>>")),
        lambda a: F.concat(
            F.coalesce(F.transform(a["efoTraits"], lambda t: t["trait"]), no_traits),
            F.array(a["diseaseTrait"]["trait"]),
        ),
    )
    return F.array_sort(F.array_distinct(F.array_compact(F.flatten(per_association))))


def with_traits(df: DataFrame, json_column: str) -> DataFrame:
    return df.withColumn("traits", trait_list(col(json_column)))


def with_variant_facts(df: DataFrame, json_column: str, rsid: str | None = None) -> DataFrame:
    """Adds consequence label, alleles, gene and location of the first mapping.

    There are no facts (all NULL) without a payload, for a payload that is no
    JSON object, for one whose list of mappings is empty or no list, and for a
    consequence that is NULL.  A missing key gives the fixed text for unknown.
    The gene is named if the payload has synonyms: by its name, else by ``rsid``.
    """
    parsed = df.withColumn("_facts", F.try_parse_json(col(json_column)))

    def there(path: str) -> Column:
        return F.try_variant_get("_facts", path, "variant").isNotNull()

    def text(path: str, missing: str) -> Column:
        return F.when(there(path), F.try_variant_get("_facts", path, "string")).otherwise(F.lit(missing))

    mappings = F.size(F.try_variant_get("_facts", "$.mappings", "array<variant>"))
    code = text("$.most_severe_consequence", L.UNKNOWN_CONSEQUENCE)
    known = (
        (F.schema_of_variant("_facts").startswith("OBJECT"))
        & code.isNotNull()
        & F.when(there("$.mappings"), F.coalesce(mappings, F.lit(0)) > 0).otherwise(F.lit(True))
    )
    own_name = col(rsid) if rsid is not None else F.lit(None).cast("string")
    name = F.when(there("$.name"), F.try_variant_get("_facts", "$.name", "string")).otherwise(own_name)
    facts = {
        "consequence": consequence_label(code),
        "alleles": text("$.mappings[0].allele_string", L.NOT_AVAILABLE),
        "gene": F.when(there("$.synonyms"), name).otherwise(F.lit(L.UNKNOWN_GENE)),
        "location": text("$.mappings[0].location", L.NOT_AVAILABLE),
    }
    return parsed.withColumns({c: F.when(known, value) for c, value in facts.items()}).drop("_facts")


def annotate(df: DataFrame, annotations: DataFrame, roles: Roles | None = None, id_filter: bool | None = None) -> DataFrame:
    """Left join on the normal form of the id; ``message`` says why nothing was found.

    ``annotations`` has one row per ``rsid`` (in normal form) and any further
    columns; a row whose further columns are all NULL counts as known but empty.

    With ``id_filter`` a Bloom filter of the annotated ids parts ``df``: rows that
    cannot match get their message where they are, and only the others are
    shuffled.  ``df`` is scanned twice for that, so it is the default only where
    the annotations are too large for Spark to broadcast them.
    """
    r = roles_of(df, roles)
    r.need("snp")
    facts = [c for c in annotations.columns if c != "rsid"]
    marked = annotations.select("rsid", *[col(c) for c in facts], F.lit(True).alias("_known"))
    named = df.withColumn("rsid", rsid_normal(col(r.snp)))
    if id_filter is None:
        id_filter = plan_bytes(annotations) > _broadcast_limit(df)
    if id_filter:
        parted = could_match(named, "rsid", annotations.select("rsid"), "rsid")
        likely = parted.filter("_maybe").drop("_maybe").join(marked, "rsid", "left")
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in marked.schema.fields if f.name != "rsid"]
        never = parted.filter("not _maybe").drop("_maybe").select(*[col(c) for c in named.columns], *none)
        joined = likely.unionByName(never)
    else:
        joined = lookup_join(named, marked, ["rsid"])
    empty = F.lit(True)
    for c in facts:
        empty = empty & col(c).isNull()
    message = (
        F.when(col("rsid").isNull(), L.MSG_BAD_ID)
        .when(col("_known").isNull(), L.MSG_NOT_FOUND)
        .when(empty, L.MSG_EMPTY)
    )
    return joined.withColumn("message", message).drop("_known")


def _broadcast_limit(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
