"""The source tables of the reports: names, declared columns, and typing of raw text columns."""

from pyspark.sql import DataFrame

from carelens.fixed_values import DASHBOARD_2022_ONLY, DASHBOARD_FTE, DASHBOARD_PERSONS, DASHBOARD_RATES
from carelens.functions.keys import named, ref
from carelens.functions.numbers import decimal_comma, lenient_int

# Table names (file stems) and the columns the reports read.
FACILITIES = "t-finess"
COMPLAINTS = "reclamations_mars20_mars2023"
INCIDENTS = "all_sivss"
OCCUPATION_2020 = "occupation_2019_2020"
OCCUPATION_2021 = "occupation_2021"
OCCUPATION_2022 = "occupation_2022"
TOTAL_CAPACITY = "capacite_totale_auto"
CAPACITIES = "capacites_ehpad"
LODGING = "hebergement"
DEPENDENCY = "gmp_pmp"
INDICATORS = "EHPAD_Indicateurs_2021_REG_agg"
DASHBOARDS = {
    2020: "export-tdbesms-2020-region_agg",
    2021: "export-tdbesms-2021-region-agg",
    2022: "export-tdbesms-2022-region-agg",
}
CLASSES = "choix_errd_ca_pa_ph"
CLASS_DUPLICATES = "doublons_errd_ca"
MISSIONS = "HELIOS_SICEA_MISSIONS_2020_20230113"
COMMUNES = "commune_2022"
DEPARTMENTS = "departement_2022"
REGIONS_TABLE = "region_2022"
FINANCE_LABEL = "structure_-_finess_-_raison_sociale"
CLASS_LABEL = "finess_-_rs_et"

# Finance tables as (table, class, measure, value column).
FINANCE_SOURCES = (
    ("errd_charges", "ERRD", "charges", "charges_dexploitation"),
    ("errd_produitstarif", "ERRD", "tariff_income", "groupe_i__produits_de_la_tarification"),
    ("errd_produits70", "ERRD", "account70_income", "unnamed_1"),
    ("errd_produitsencaiss", "ERRD", "total_income", "produits_dexploitation"),
    ("caph_charges", "CA PH", "charges", "charges_dexploitation"),
    ("caph_produitstarif", "CA PH", "tariff_income", "groupe_i__produits_de_la_tarification"),
    ("caph_produits70", "CA PH", "account70_income", "unnamed_1"),
    ("caph_produitsencaiss", "CA PH", "total_income", "produits_dexploitation"),
    ("capa_charges", "CA PA", "charges", "charges_dexploitation"),
    ("capa_produitstarif", "CA PA", "tariff_income", "produits_de_lexercice"),
)


Schema = dict[str, str]


def _columns(**groups: str) -> Schema:
    return {name: kind for kind, names in groups.items() for name in names.split()}


def _dashboard(year: int) -> Schema:
    rate = "string" if year == 2020 else "double"
    numbers = [*DASHBOARD_FTE.values(), DASHBOARD_PERSONS, *(DASHBOARD_2022_ONLY.values() if year == 2022 else ())]
    return {
        "finess_geographique": "string",
        **dict.fromkeys(DASHBOARD_RATES.values(), rate),
        **dict.fromkeys(numbers, "double"),
    }


def _finance(value: str) -> Schema:
    return {FINANCE_LABEL: "string", value: "decimal(38,10)"}


# Column kinds: string, int, double, decimal(p,s).  Money is decimal, so that sums are exact and do not depend on the
# order rows arrive in; its scale is wide, so nothing is rounded before the sum.
SCHEMAS: dict[str, Schema] = {
    FACILITIES: _columns(
        string="finess categ_lib rs ej_finess ej_rs statut_jur_lib adresse_num_voie adresse_comp_voie"
        " adresse_type_voie adresse_nom_voie adresse_lieuditbp adresse_lib_routage adresse_code_postal com_code",
        int="categ_code",
    ),
    COMMUNES: _columns(string="com dep ncc comparent", int="reg"),
    DEPARTMENTS: _columns(string="dep ncc", int="reg"),
    REGIONS_TABLE: _columns(string="ncc", int="reg"),
    COMPLAINTS: _columns(string="ndeg_finessrpps signalement motifs_igas"),
    INCIDENTS: _columns(
        string="declarant_organismendeg_finess survenue_du_cas_en_collectivitendeg_finess date_de_reception"
        " reclamation declarant_type_etablissement_si_esems ceci_est_un_eigs famille_principale nature_principale"
    ),
    MISSIONS: _columns(
        string="code_finess identifiant_de_la_mission date_provisoire_visite date_reelle_visite"
        " modalite_dinvestigation"
    ),
    CLASSES: {CLASS_LABEL: "string", "cadre": "string"},
    CLASS_DUPLICATES: _columns(string="finess"),
    CAPACITIES: _columns(
        string="et-ndegfiness total_heberg_comp_inter_places_autorisees total_accueil_de_jour_places_autorisees"
        " total_accueil_de_nuit_places_autorisees"
    ),
    TOTAL_CAPACITY: _columns(string="etiquettes_de_lignes", double="somme_de_capacite_autorisee_totale_"),
    OCCUPATION_2020: _columns(string="finess_19", double="taux_occ_2020"),
    OCCUPATION_2021: _columns(string="finess", double="taux_occ_2021"),
    OCCUPATION_2022: _columns(
        string="finess", double="taux_occ_2022 taux_occ_trimestre3", int="nb_lits_autorises_installes nb_lits_occ_2022"
    ),
    LODGING: _columns(string="finesset", double="prixhebpermcs"),
    DEPENDENCY: _columns(string="finess_et", double="gmp pmp"),
    INDICATORS: _columns(string="et_finess taux_plus_10_medics_cip13 taux_hospit_mco taux_hospit_had"),
    **{table: _dashboard(year) for year, table in DASHBOARDS.items()},
    **{table: _finance(value) for table, _, _, value in FINANCE_SOURCES},
}


def _typed(name: str, kind: str) -> str:
    if kind == "string":
        return ref(name)
    if kind == "int":
        return named(f"try_cast({lenient_int(ref(name))} AS INT)", name)
    return named(decimal_comma(ref(name), to=kind), name)


def apply_schema(raw: DataFrame, schema: Schema) -> DataFrame:
    """Type the declared columns of an all-text frame; columns without declaration stay text."""
    return raw.selectExpr(*[_typed(c, schema.get(c, "string")) for c in raw.columns])


def infer_types(raw: DataFrame) -> DataFrame:
    """Type an all-text frame from its whole content in one pass: whole number, number, else text.

    Codes with a leading zero keep it: a column holding one stays text.
    """
    counts = []
    for i, name in enumerate(raw.columns):
        col = ref(name)
        plain = f"NOT trim({col}) RLIKE '^[+-]?0[0-9]'"
        counts += [
            f"count({col}) AS n{i}",
            f"count(CASE WHEN {plain} THEN try_cast(trim({col}) AS BIGINT) END) AS i{i}",
            f"count(CASE WHEN {plain} THEN {decimal_comma(col)} END) AS d{i}",
        ]
    seen = raw.selectExpr(*counts).first()
    typed = []
    for i, name in enumerate(raw.columns):
        if seen[f"n{i}"] and seen[f"i{i}"] == seen[f"n{i}"]:
            typed.append(named(f"try_cast(trim({ref(name)}) AS BIGINT)", name))
        elif seen[f"n{i}"] and seen[f"d{i}"] == seen[f"n{i}"]:
            typed.append(named(decimal_comma(ref(name)), name))
        else:
            typed.append(ref(name))
    return raw.selectExpr(*typed)
