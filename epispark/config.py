"""Run-time parameters of every operator.

All thresholds, bins, labels and weights live in one frozen dataclass so the
operators serve any notified-case line list: pass ``Config(year=..., ...)``
to re-target them.  Defaults reproduce the published analysis.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the published analysis for results to match
# (labels, bins, weights, thresholds, aliases, column contract).
# ---------------------------------------------------------------------------

SEX_LABELS = {"F": "Femenino", "M": "Masculino"}
SEX_DEFAULT = "Otro/Ind."
AREA_LABELS = {1: "Cabecera municipal", 2: "Centro poblado", 3: "Rural disperso"}
AREA_DEFAULT = "Desconocida"
HOSPITAL_LABELS = {1: "Hospitalizado", 2: "No hospitalizado"}
HOSPITAL_DEFAULT = "Desconocido"

AGE_EDGES = (0, 11, 17, 25, 35, 45, 59, 150)
AGE_LABELS = ("0–11", "12–17", "18–25", "26–35", "36–45", "46–59", "60+")
WEEK_EDGES = (0, 13, 26, 39, 52)
QUARTER_LABELS = ("T1 (Sem 1–13)", "T2 (Sem 14–26)", "T3 (Sem 27–39)", "T4 (Sem 40–52)")
SEMESTER_LABELS = ("H1 (Sem 1–26)", "H2 (Sem 27–52)")

MONTH_NAMES = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
               "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")
MONTH_SHORT = ("Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep",
               "Oct", "Nov", "Dic")

# index components in summation order, with weights (must sum to 1)
INDEX_WEIGHTS = (
    ("rate_100k", 0.35),
    ("pct_adolescent", 0.25),
    ("trend", 0.20),
    ("pct_hospitalised", 0.10),
    ("pct_psychiatric", 0.10),
)
# class thresholds on the rounded index, highest first
PRIORITY_CLASSES = (("Crítica", 80.0), ("Alta", 60.0), ("Media", 40.0))
PRIORITY_DEFAULT = "Baja"
PRIORITY_ORDER = ("Crítica", "Alta", "Media", "Baja")

REGION_ALIASES = {
    "BOGOTA D.C.": "BOGOTÁ D.C.",
    "BOGOTA": "BOGOTÁ D.C.",
    "BOGOTÁ": "BOGOTÁ D.C.",
    "BOGOTÁ D.C": "BOGOTÁ D.C.",
    "BOGOTA DC": "BOGOTÁ D.C.",
    "BOGOTÁ DC": "BOGOTÁ D.C.",
    "NORTE DE SANTANDER": "NORTE SANTANDER",
    "NORTE SANTANDER": "NORTE SANTANDER",
    "SAN ANDRES": "SAN ANDRÉS",
    "SAN ANDRES Y PROVIDENCIA": "SAN ANDRÉS",
    "SAN ANDRÉS": "SAN ANDRÉS",
}
NON_TERRITORIAL = ("EXTERIOR",)
AREA_CODE_OVERRIDES = {"BOGOTÁ D.C.": "11001"}
GROUP_DEFAULT = "Sin especificar"

# readable names of the risk-group flags (fallback: the column name)
GP_LABELS = {
    "gp_psychiatric": "Antecedente psiquiátrico",
    "gp_migrant": "Población migrante",
    "gp_prison": "Privado de libertad",
    "gp_pregnant": "Gestante",
    "gp_indigenous": "Población indígena",
    "gp_icbf": "Beneficiario ICBF",
    "gp_disabled": "Con discapacidad",
    "gp_displaced": "Desplazado/a",
    "gp_violence": "Víctima de violencia",
    "gp_other": "Otros grupos",
}

# original line-list column names -> canonical names (for read_cases(mapping=...))
SOURCE_NAMES = {
    "CONSECUTIVE": "case_id", "COD_EVE": "event_code", "Nombre_evento": "event_name",
    "ANO": "epi_year", "SEMANA": "epi_week", "FEC_NOT": "notified_text",
    "INI_SIN": "onset_text", "FEC_CON": "consulted_text", "FEC_HOS": "admitted_text",
    "FECHA_NTO": "born_text", "EDAD": "age", "UNI_MED": "age_unit", "SEXO": "sex",
    "AREA": "area_type", "PAC_HOS": "hospital_code", "COD_DPTO_O": "region_code",
    "COD_MUN_O": "local_code", "Departamento_ocurrencia": "region_name",
    "Municipio_ocurrencia": "local_name", "GP_PSIQUIA": "gp_psychiatric",
    "GP_MIGRANT": "gp_migrant", "GP_CARCELA": "gp_prison", "GP_GESTAN": "gp_pregnant",
    "GP_INDIGEN": "gp_indigenous", "GP_POBICFB": "gp_icbf", "GP_DISCAPA": "gp_disabled",
    "GP_DESPLAZ": "gp_displaced", "GP_VIC_VIO": "gp_violence", "GP_OTROS": "gp_other",
    "nom_grupo": "group_name", "estrato": "stratum", "sem_ges": "gestation_weeks",
    "PER_ETN": "ethnicity", "OCUPACION": "occupation", "nacionalidad": "nationality",
    "COD_DPTO_R": "residence_region_code", "COD_MUN_R": "residence_local_code",
    "COD_DPTO_N": "notifier_region_code", "COD_MUN_N": "notifier_local_code",
}

# input contract (canonical names); dates arrive as text
REQUIRED_COLUMNS = (
    "case_id", "event_code", "event_name", "epi_year", "epi_week", "notified_text",
    "age", "age_unit", "sex", "area_type", "hospital_code",
    "region_code", "local_code", "region_name", "local_name",
)
OPTIONAL_COLUMNS = (
    "gp_psychiatric", "gp_migrant", "gp_prison", "gp_pregnant", "gp_indigenous",
    "gp_icbf", "gp_disabled", "gp_displaced", "gp_violence", "gp_other",
    "onset_text", "consulted_text", "admitted_text", "ethnicity", "group_name",
)
VALID_SEX = ("F", "M")
VALID_AREA = (1, 2, 3)
VALID_HOSPITAL = (1, 2)
EXPECTED_EVENT_CODES = (356,)

# columns dropped by cleaning when present (high null share or no variance); the
# event code is not among them, as the contract requires it (``event_code``)
DROP_COLUMNS = (
    "GRU_POB", "FEC_DEF", "CBMTE", "CER_DEF", "FM_FUERZA", "FM_UNIDAD", "FM_GRADO",
    "COD_PAIS_O", "COD_PAIS_R", "COD_PAIS_N", "COD_PRE", "COD_SUB",
    "TIP_CAS", "CON_FIN", "Estado_final_de_caso", "nom_est_f_caso", "AJUSTE",
    "va_sispro", "FEC_AJU", "FEC_ARC_XL", "confirmados",
)

# text date column -> typed date column
DATE_COLUMNS = (
    ("notified_text", "notified_on"),
    ("onset_text", "onset_on"),
    ("consulted_text", "consulted_on"),
    ("admitted_text", "admitted_on"),
    ("born_text", "born_on"),
)

# area-level model features (null -> 0), in model order
MODEL_FEATURES = (
    "rate_100k", "pct_adolescent", "pct_young_adult", "trend", "pct_hospitalised",
    "pct_psychiatric", "cases", "pct_minor", "pct_female", "pct_rural",
)
MODEL_TARGET = "priority"


@dataclass(frozen=True)
class Config:
    year: int | None = 2024                 # epidemiological year kept by cleaning
    onset_max_days: int = 365               # onset further back than this is nulled
    age_gap_years: float = 2.0              # reported vs computed age audit
    default_population: float = 50000.0     # when neither area nor region is known
    min_cases: int = 5                      # robustness / suppression cell size
    emerging_trend: float = 0.5
    event_code: int = EXPECTED_EVENT_CODES[0]    # of line lists that carry none
    max_rows: int = 500_000                 # validator guard rail (warning)
    age_min: int = 0
    age_max: int = 120
    year_days: float = 365.25
    weights: tuple = INDEX_WEIGHTS
    region_aliases: dict = field(default_factory=lambda: dict(REGION_ALIASES))
    non_territorial: tuple = NON_TERRITORIAL
    area_code_overrides: dict = field(default_factory=lambda: dict(AREA_CODE_OVERRIDES))
    drop_columns: tuple = DROP_COLUMNS
    date_columns: tuple = DATE_COLUMNS
    model_features: tuple = MODEL_FEATURES
    n_clusters: int = 4
    dedup_full_rows: bool = True            # False only for feeds known to hold no copies
    seed: int = 42

    def __post_init__(self):
        total = sum(w for _, w in self.weights)
        if abs(total - 1.0) > 1e-9:
            raise ValueError(f"index weights must sum to 1, got {total}")

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)
