"""Thresholds, limits and result texts that must stay as they are.

Everything in this module is data.  Result texts are Spanish because the
result tables users compare against carry Spanish texts.
"""

# Significance levels (strict "<" everywhere).
NOMINAL = 0.05
SUGGESTIVE = 1e-5
GENOME_WIDE = 5e-8
LEAD_EFFECT_LEVEL = 5e-6

# Work limits.
LOCUS_WINDOW_KB = 250
OVERLAP_MARGIN_KB = 0
HIGH_NULL_PCT = 20
CATEGORY_LIMIT = 40
VALUE_COUNT_LIMIT = 500
COLLINEAR_R = 0.85
CHI2_MEDIAN_1DF = 0.4549

# Tiers are cumulative, not disjoint: (label, p limit or None for all rows).
TIERS = (
    ("Todas", None),
    ("p < 0.05", NOMINAL),
    ("p < 1e-5", SUGGESTIVE),
    ("p < 5e-8", GENOME_WIDE),
)

# Effect kinds on a log scale (compared in lower case).
LOG_KINDS = ("log_or", "logor", "log_odds", "log_oddsratio", "beta", "log")

# Texts of the odds-ratio interpretation.
OR_UNKNOWN = "—"
OR_RISK = "↑ riesgo ~%.0f%%"
OR_PROTECTIVE = "↓ riesgo ~%.0f%% (protector)"
OR_NONE = "Sin efecto aparente"

# Texts of the derived metrics.
NO_SIGNIFICANT_CHR = "Ninguno"
NO_CHR = "—"

# Null-rate bands of a column.
STATUS_EMPTY = "Vacía (100%)"
STATUS_HIGH = "Alta nulidad (>20%)"
STATUS_OK = "OK"

# Bands of the inflation factor.
INFLATION_NONE = "Sin inflación"
INFLATION_LIGHT = "Inflación leve"
INFLATION_STRONG = "Inflación significativa"

PRESENT = "✓"
ABSENT = ""

# Most severe consequence code -> label.
CONSEQUENCES = {
    "intron_variant": "Variante en intrón (no codificante)",
    "missense_variant": "Variante de cambio de sentido",
    "synonymous_variant": "Variante sinónima",
    "intergenic_variant": "Variante intergénica",
    "non_coding_transcript_exon_variant": "Variante en exón no codificante",
    "regulatory_region_variant": "Variante en región reguladora",
    "3_prime_UTR_variant": "Variante en región 3' UTR",
    "5_prime_UTR_variant": "Variante en región 5' UTR",
}
UNKNOWN_CONSEQUENCE = "Desconocida"
UNKNOWN_GENE = "Desconocido"
NOT_AVAILABLE = "No disponible"

# Messages of the variant annotation.
MSG_BAD_ID = "El ID debe tener el formato estándar 'rs...' (ej. rs11210887)."
MSG_NOT_FOUND = "Variante sin registros clínicos en la base de datos."
MSG_EMPTY = "La variante existe, pero no tiene información clínica mapeada."
