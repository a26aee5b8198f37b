"""Scalar functions, ``Column`` in and ``Column`` out, all inside codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from assocframe import labels as L


def round_even(value: Column, digits: int = 0) -> Column:
    """Round half to even on the scaled double, the way numpy rounds."""
    if digits == 0:
        return F.rint(value)
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole * 100`` rounded; NULL when ``whole`` is zero."""
    ratio = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return round_even(ratio * 100.0, digits)


def percent_text(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f%%", value)


def neg_log10(p: Column) -> Column:
    """-log10(p); NULL for p = 0 or below."""
    return -F.log10(p)


def neg_log10_floor(p: Column, floor: float = 1e-300) -> Column:
    return -F.log10(F.greatest(p, F.lit(floor)))


def neg_log10_inf(p: Column) -> Column:
    """-log10(p), infinite for p = 0, NULL for NULL."""
    return F.when(p > 0, -F.log10(p)).when(p.isNotNull(), F.lit(math.inf))


def odds_ratio(
    effect: Column | None, kind: Column | None = None, direct: Column | None = None
) -> Column:
    """Odds ratio of an effect.

    With an effect: ``exp(effect)`` when its kind is on a log scale or when the
    table has no kind column at all, else the effect itself (a NULL kind counts
    as not logarithmic).  Without an effect: the direct odds ratio, if any.
    """
    if effect is not None:
        if kind is None:
            return F.exp(effect)
        return F.when(F.lower(kind).isin(*L.LOG_KINDS), F.exp(effect)).otherwise(effect)
    return direct if direct is not None else F.lit(None).cast("double")


def interpret_or(value: Column) -> Column:
    """Text for an unrounded odds ratio; the percent is rounded half to even."""
    return (
        F.when(value.isNull(), F.lit(L.OR_UNKNOWN))
        .when(value > 1, F.format_string(L.OR_RISK, F.rint((value - 1) * 100)))
        .when(value < 1, F.format_string(L.OR_PROTECTIVE, F.rint((1 - value) * 100)))
        .otherwise(F.lit(L.OR_NONE))
    )


def chr_rank(chrom: Column) -> Column:
    """Natural chromosome order: digits by value, everything else 999."""
    digits = F.when(chrom.rlike("^[0-9]+$"), chrom.try_cast("bigint"))
    return F.when(chrom.isNotNull(), F.coalesce(digits, F.lit(999)))


def chr_order(chrom: Column) -> list[Column]:
    """Sort keys of the natural order: digits first, then text, NULL last."""
    return [chr_rank(chrom).asc_nulls_last(), chrom.asc_nulls_last()]


def log1p_clipped(value: Column) -> Column:
    return F.when(value.isNotNull(), F.log1p(F.greatest(value, F.lit(0.0))))


def region_label(start: Column, end: Column) -> Column:
    """``start–end`` in megabases with two decimals."""
    return F.format_string("%.2f–%.2f Mb", start / 1e6, end / 1e6)


def null_band(pct_null: Column) -> Column:
    return (
        F.when(pct_null == 100, L.STATUS_EMPTY)
        .when(pct_null > L.HIGH_NULL_PCT, L.STATUS_HIGH)
        .otherwise(L.STATUS_OK)
    )


def inflation_band(lam: Column) -> Column:
    return F.when(
        lam.isNotNull(),
        F.when(lam < 1.05, L.INFLATION_NONE)
        .when(lam < 1.1, L.INFLATION_LIGHT)
        .otherwise(L.INFLATION_STRONG),
    )


def capitalize(text: Column) -> Column:
    """First letter upper case, the rest lower case."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def consequence_label(code: Column) -> Column:
    """Label of a consequence code; unknown codes are made readable."""
    known = F.create_map(*[F.lit(x) for pair in L.CONSEQUENCES.items() for x in pair])
    code = F.coalesce(code, F.lit(L.UNKNOWN_CONSEQUENCE))
    return F.coalesce(F.try_element_at(known, code), capitalize(F.replace(code, F.lit("_"), F.lit(" "))))


def rsid_normal(text: Column) -> Column:
    """Trimmed lower-case id when it is an rs id, else NULL."""
    clean = F.lower(F.trim(text.cast("string")))
    return F.when(clean.startswith("rs"), clean)


def header_normal(text: Column) -> Column:
    return F.translate(F.lower(text), "_-", "  ")


# The published coefficients of Wichura's algorithm AS 241 (PPND16) for the
# inverse of the normal distribution, lowest power first: numerator and denominator for
# the centre, the near tail and the far tail.
INVERSE_NORMAL = {
    "centre": (
        (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
         4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
        (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
         2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
    ),
    "near": (
        (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
         1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
        (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
         1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
    ),
    "far": (
        (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
    ),
}


def _number(x: float) -> str:
    """A double literal of both SQL dialects."""
    text = repr(x)
    return text if "e" in text else text + "e0"


def _ratio(part: str, x: str) -> str:
    """A ratio of two polynomials as SQL, by Horner's rule."""
    sides = []
    for coefficients in INVERSE_NORMAL[part]:
        text = _number(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            text = f"({text} * {x} + {_number(c)})"
        sides.append(text)
    return f"{sides[0]} / {sides[1]}"


def chi2_from_p_sql(p: str) -> str:
    """Chi-square statistic (1 df) with upper tail ``p`` as a SQL expression; NULL outside (0, 1]."""
    half, q, r = f"({p} / 2e0)", f"({p} / 2e0 - 5e-1)", f"sqrt(-ln({p} / 2e0))"
    z = (
        f"CASE WHEN {half} >= 0.075e0 THEN {q} * ({_ratio('centre', f'(0.180625e0 - {q} * {q})')}) "
        f"WHEN {r} <= 5e0 THEN {_ratio('near', f'({r} - 1.6e0)')} ELSE {_ratio('far', f'({r} - 5e0)')} END"
    )
    return f"CASE WHEN {p} > 0 AND {p} <= 1 THEN power({z}, 2) END"


def chi2_from_p(column: str) -> Column:
    """Chi-square statistic (1 df) with the upper tail in a column; NULL outside (0, 1]."""
    return F.expr(chi2_from_p_sql(f"`{column}`"))
