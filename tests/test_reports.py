"""Reports over a small register worked out by hand, and what holds for any register."""

import pytest

from carelens import tables as T
from carelens.fixed_values import (
    COMPLAINT_MOTIFS,
    DASHBOARD_FTE,
    DASHBOARD_PERSONS,
    DASHBOARD_RATES,
    FAMILY_CARE,
    FAMILY_EVENT,
    LABELS,
)
from carelens.functions.keys import ref
from carelens.operators.aggregates import incident_profile
from carelens.operators.joins import fanout_audit
from carelens.plans import reports as R
from carelens.testbed.views import report_tables

A, B, C, E_, F_ = "010001234", "010005678", "2A0001234", "010009999", "010008888"


def facility(finess, category, commune, **more):
    return {"finess": finess, "categ_code": category, "com_code": commune, "rs": f"ET {finess}", **more}


def finance(table_key, *pairs):
    value = next(v for t, _, _, v in T.FINANCE_SOURCES if t == table_key)
    return [{T.FINANCE_LABEL: label, value: amount} for label, amount in pairs]


def dashboard(key, rate, staff, persons, **more):
    return {
        "finess_geographique": key,
        **dict.fromkeys(DASHBOARD_RATES.values(), rate),
        **dict.fromkeys(DASHBOARD_FTE.values(), staff),
        DASHBOARD_PERSONS: persons,
        **more,
    }


def incident(declarant, place, flag, serious, family, nature=None):
    return {
        "declarant_organismendeg_finess": declarant, "survenue_du_cas_en_collectivitendeg_finess": place,
        "reclamation": flag, "ceci_est_un_eigs": serious, "famille_principale": family, "nature_principale": nature,
    }


def mission(key, number, planned, real, mode="Sur site"):
    return {
        "code_finess": key, "identifiant_de_la_mission": number, "date_provisoire_visite": planned,
        "date_reelle_visite": real, "modalite_dinvestigation": mode,
    }


CAP = ("total_heberg_comp_inter_places_autorisees", "total_accueil_de_jour_places_autorisees",
       "total_accueil_de_nuit_places_autorisees")

DATA = {
    T.FACILITIES: [
        facility("10001234", 500, "1004", adresse_num_voie="12.0", adresse_nom_voie="DU LAC", adresse_lib_routage="BOURG",
                 adresse_code_postal="1000 CEDEX", ej_finess="10000001"),
        facility("10005678.0", 159, "01004"),
        facility("2A0001234", 159, "2A004"),
        facility("990000001", 999, "1004"),
        facility(E_, 159, "01390"),
        facility(F_, 500, "1004"),
        facility("010007777", 159, "01999"),
    ],
    T.COMMUNES: [
        {"com": "01004", "dep": "01", "reg": 84, "ncc": "AMBERIEU"},
        {"com": "2A004", "dep": "2A", "reg": 94, "ncc": "AJACCIO"},
        {"com": "01390", "comparent": "01004", "ncc": "ASSOCIEE"},
        {"com": "01999", "comparent": "01998", "ncc": "ORPHELINE"},
        {"com": "01998", "comparent": "01998", "ncc": "SEULE"},
    ],
    T.DEPARTMENTS: [{"dep": "01", "reg": 84, "ncc": "AIN"}, {"dep": "2A", "reg": 94, "ncc": "CORSE DU SUD"}],
    T.REGIONS_TABLE: [{"reg": 84, "ncc": "ARA"}, {"reg": 94, "ncc": "CORSE"}],
    T.COMPLAINTS: [
        {"ndeg_finessrpps": "10001234", "motifs_igas": f"{COMPLAINT_MOTIFS[0].upper()} ; {COMPLAINT_MOTIFS[7]}"},
        {"ndeg_finessrpps": "10001234.0", "signalement": "Non", "motifs_igas": COMPLAINT_MOTIFS[0]},
        {"ndeg_finessrpps": A, "signalement": "Non"},
        {"ndeg_finessrpps": A, "signalement": "Oui", "motifs_igas": COMPLAINT_MOTIFS[0]},
        {"ndeg_finessrpps": B, "signalement": "Oui"},
        {"ndeg_finessrpps": B, "signalement": "Autre"},
        {"ndeg_finessrpps": None, "signalement": "Non"},
    ],
    T.INCIDENTS: [
        incident(f"ORG {A}", None, "Non", "Non", FAMILY_EVENT, "Chute"),
        incident(f"ORG {A}", f"{A} - ET", "Non", "Oui", FAMILY_CARE, "Chute"),
        incident(f"ORG {B}", "10001234", "Non", "Non", FAMILY_CARE, "Suicide"),
        incident(f"ORG {A}", None, "Non", "Non", "Autre", "Chute"),
        incident(f"ORG {A}", None, "Oui", "Oui", FAMILY_EVENT, "Chute"),
        incident(f"ORG {A}", None, None, "Oui", FAMILY_EVENT, "Chute"),
        incident(f"ORG {A}", None, "Non", "Oui", None, "Hors liste"),
    ],
    T.MISSIONS: [
        mission("10001234", "M1", None, "31/12/2023"),
        mission("10001234", "M1", None, "31/12/2023"),
        mission(A, "M2", None, "02/01/2021", "Sur pièces"),
        mission(A, "M3", "01/02/2024", "01/01/2024"),
        mission(A, "M4", None, "01/01/2024"),
        mission(A, "M5", None, "31/12/2020"),
        mission(A, "M6", None, "bientôt"),
        mission(None, "M7", None, "01/06/2022"),
    ],
    T.CLASSES: [
        {T.CLASS_LABEL: f"{A} - ET A", "cadre": "ERRD"},
        {T.CLASS_LABEL: f"{A} - ET A", "cadre": "CA PA"},
        {T.CLASS_LABEL: f"{B} - ET B", "cadre": "CA PA"},
        {T.CLASS_LABEL: f"{C} - ET C", "cadre": "CA PH"},
        {T.CLASS_LABEL: f"{E_} - ET E", "cadre": None},
    ],
    T.CLASS_DUPLICATES: [{"finess": f"{A} - ET A"}, {"finess": f"{E_} - ET E"}],
    "errd_charges": finance("errd_charges", (f"{A} - ET A", "100.25"), (f"{A} - ET A", "0.25"), (f"{B} - ET B", "7")),
    "errd_produits70": finance("errd_produits70", (f"{A} - ET A", "12.50")),
    "capa_charges": finance("capa_charges", (f"{A} - ET A", "999"), (f"{B} - ET B", "55.5")),
    "caph_produitsencaiss": finance("caph_produitsencaiss", (f"{C} - ET C", "-2.5")),
    T.CAPACITIES: [
        {"et-ndegfiness": "10001234", CAP[0]: "40", CAP[1]: "12.7", CAP[2]: None},
        {"et-ndegfiness": F_, CAP[0]: "abc"},
    ],
    T.TOTAL_CAPACITY: [
        {"etiquettes_de_lignes": "10001234", "somme_de_capacite_autorisee_totale_": 40.0},
        {"etiquettes_de_lignes": B, "somme_de_capacite_autorisee_totale_": 17.9},
    ],
    T.OCCUPATION_2022: [
        {"finess": "10005678", "taux_occ_2022": 90.5, "nb_lits_occ_2022": 10},
        {"finess": B, "taux_occ_2022": 91.5, "nb_lits_occ_2022": 11},
    ],
    T.OCCUPATION_2020: [{"finess_19": "10001234", "taux_occ_2020": 88.0}],
    T.LODGING: [{"finesset": "10001234", "prixhebpermcs": 61.5}],
    T.DEPENDENCY: [{"finess_et": "10001234", "gmp": 712.5, "pmp": 199.4}],
    T.INDICATORS: [{"et_finess": A, "taux_plus_10_medics_cip13": "12,5", "taux_hospit_mco": "abc", "taux_hospit_had": "3"}],
    T.DASHBOARDS[2020]: [dashboard("10001234", "12,5", 1.0, 10.0)],
    T.DASHBOARDS[2021]: [dashboard(A, 7.5, None, 10.0)],
    T.DASHBOARDS[2022]: [
        dashboard("10001234", 2.0, 2.0, 40.0, **{"-_dont_nombre_detp_reels_de_medecin_coordonnateur": 0.125}),
        dashboard(B, 1.0, 1.0, 0.0),
    ],
}


@pytest.fixture(scope="module")
def tables(spark):
    made = {}
    for name, schema in T.SCHEMAS.items():
        texts = ", ".join(f"`{c}` {'string' if k.startswith('decimal') else k}" for c, k in schema.items())
        rows = [tuple(row.get(c) for c in schema) for row in DATA.get(name, [])]
        typed = [f"CAST({ref(c)} AS {k}) AS {ref(c)}" for c, k in schema.items()]
        made[name] = spark.createDataFrame(rows, texts).selectExpr(*typed)
    return made


def by_facility(report):
    found = {}
    for row in report.collect():
        found.setdefault(row[LABELS["finess"]], []).append({f: row[v] for f, v in LABELS.items() if v in row})
    return found


@pytest.fixture(scope="module")
def control(tables):
    return by_facility(R.control_report(tables, 84))


def check(row, **expected):
    assert {f: row[f] for f in expected} == expected


def test_facilities_of_the_region(control):
    assert {k: len(v) for k, v in control.items()} == {A: 1, B: 2, E_: 1, F_: 1}


def test_identity(control):
    check(control[A][0], region="ARA", dep_code="01", dep_name="AIN", commune="AMBERIEU", commune_code="01004",
          postal_code="01000", legal_finess="010000001", address="12 DU LAC BOURG")
    check(control[E_][0], commune="ASSOCIEE", dep_name="AIN")


def test_capacity(control):
    check(control[A][0], capacity=52, capacity_hp=40, capacity_aj=12, capacity_ht=None)
    check(control[F_][0], capacity=0, capacity_hp=None)
    check(control[B][0], capacity=17)
    check(control[E_][0], capacity=None)


def test_repeated_key_repeats_the_row(control):
    assert sorted(r["residents"] for r in control[B]) == [10, 11]
    assert {r["name"] for r in control[B]} == {"ET 10005678.0"}


def test_activity(control):
    check(control[A][0], occupancy_2020=88.0, day_price=61.5, gmp=713.0, pmp=199.0, many_drugs=12.5, mco_rate=None,
          had_rate=3.0, emergency_rate="", dashboard_entry="")


def test_finance(tables, control):
    check(control[A][0], charges=101.0, account70_income=13.0, tariff_income=None, total_income=None)
    check(control[B][0], charges=56.0, account70_income=0.0, total_income=0.0, tariff_income=None)
    check(control[E_][0], charges=None, account70_income=None)
    corsica = by_facility(R.control_report(tables, 94))
    check(corsica[C][0], total_income=-3.0, charges=None)


def test_staff(control):
    check(control[A][0], absence_2019=12.5, absence_2020=7.5, absence_2021=2.0, absence_mean=7.33,
          fte_per_user_2019=1.1, fte_per_user_2020=None, fte_per_user_2021=0.55, fte_total=22.0, fte_coordinator=0.13,
          care_fte_per_user=0.1)
    assert control[A][0]["fte_per_user_mean"] == pytest.approx(0.825)
    check(control[B][0], fte_per_user_2021=None, fte_total=11.0, fte_per_user_mean=None, absence_mean=1.0)


def test_complaints(control):
    check(control[A][0], complaints=3, complaint_rate=7.5, motif_1=2, motif_8=1, motif_2=0)
    check(control[B][0], complaints=0, complaint_rate=0.0, motif_1=0)


def test_incidents(control):
    check(control[A][0], events=1, serious_events=2, care_events=1, all_events=4, nature_3=2, nature_16=1, nature_1=0)
    check(control[F_][0], events=0, all_events=0)


def test_inspections(control):
    check(control[A][0], inspections_done=2, inspections_on_site=1, inspections_on_file=1, inspections_planned=1)


def test_complaints_variant(tables):
    report = R.targeting_report(tables, 84, R.COMPLAINTS)
    found = by_facility(report)
    check(found[A][0], flagged=1, complaints=3, external_mean=7.3333)
    check(found[B][0], flagged=1, complaints=0)
    assert LABELS["all_events"] not in report.columns


@pytest.mark.parametrize("kind,variant,width", [
    (R.TARGETING, R.INCIDENTS, 73), (R.CONTROL, R.INCIDENTS, 127),
    (R.TARGETING, R.COMPLAINTS, 71), (R.CONTROL, R.COMPLAINTS, 107),
])
def test_widths(kind, variant, width):
    fields = R.report_fields(kind, variant)
    assert len(fields) == width and len({LABELS[f] for f in fields}) == width


def test_variant_follows_from_the_region():
    assert (R.variant_of(32), R.variant_of(84)) == (R.COMPLAINTS, R.INCIDENTS)


@pytest.fixture(scope="module")
def small(spark):
    return report_tables(spark, "/root/testdata/sf0.001")


@pytest.mark.parametrize("kind", [R.TARGETING, R.CONTROL])
def test_all_regions_hold_each_region(small, kind):
    every = R.all_regions_report(small, kind, range(5), (3,))
    for region, variant in ((2, R.INCIDENTS), (3, R.COMPLAINTS)):
        build = R.targeting_report if kind == R.TARGETING else R.control_report
        own = build(small, region, variant)
        part = R.region_layout(every.where(f"region_code = {region}"), kind, variant)
        assert part.columns == own.columns
        assert sorted(map(repr, part.collect())) == sorted(map(repr, own.collect()))


def test_report_is_in_establishment_order(small):
    keys = [r[0] for r in R.targeting_report(small, 1).select(ref(LABELS["finess"])).collect()]
    assert keys and keys == sorted(keys)


def test_kinds_of_incidents_add_up(small):
    rows = incident_profile(small[T.INCIDENTS]).collect()
    assert rows and all(r["nb_events"] == r["nb_ei"] + r["nb_eigs"] + r["nb_eias"] <= r["nb_signa"] for r in rows)


def test_audit_names_the_repeated_keys(tables):
    audit = fanout_audit({"o": (tables[T.OCCUPATION_2022], "finess"), "c": (tables[T.CLASSES], T.CLASS_LABEL)})
    assert {tuple(r) for r in audit.collect()} == {("c", f"{A} - ET A", 2)}
