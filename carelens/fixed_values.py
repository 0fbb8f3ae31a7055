"""Fixed values of the reporting domain.

Everything here is data that must be spelled exactly for results to be right: code lists, source wordings,
output labels, dates.  No logic lives in this module.
"""

# Establishment category codes kept in the register (102 codes).
CATEGORY_CODES = (
    159, 160, 162, 165, 166, 172, 175, 176, 177, 178, 180, 182, 183, 184, 185, 186, 188, 189, 190, 191, 192, 193,
    194, 195, 196, 197, 198, 199, 2, 200, 202, 205, 207, 208, 209, 212, 213, 216, 221, 236, 237, 238, 241, 246, 247,
    249, 250, 251, 252, 253, 255, 262, 265, 286, 295, 343, 344, 354, 368, 370, 375, 376, 377, 378, 379, 381, 382,
    386, 390, 393, 394, 395, 396, 397, 402, 411, 418, 427, 434, 437, 440, 441, 445, 446, 448, 449, 450, 453, 460,
    461, 462, 463, 464, 500, 501, 502, 606, 607, 608, 609, 614, 633,
)

# Fixed value: the category whose capacity is the sum of its three authorised capacities.
SUMMED_CAPACITY_CATEGORY = 500

# Wordings searched in the complaint motif text ("?" is literal: a lost apostrophe in the source).
COMPLAINT_MOTIFS = (
    "Hôtellerie-locaux-restauration",
    "Problème d?organisation ou de fonctionnement de l?établissement ou du service",
    "Problème de qualité des soins médicaux",
    "Problème de qualité des soins paramédicaux",
    "Recherche d?établissement ou d?un professionnel",
    "Mise en cause attitude des professionnels",
    "Informations et droits des usagers",
    "Facturation et honoraires",
    "Santé-environnementale",
    "Activités d?esthétique réglementées",
    "A renseigner",
    "COVID-19",
)

# Fixed value: how many of these motifs, from the first, the reports show.
REPORTED_MOTIFS = 10

# Incident families and incident natures.
FAMILY_EVENT = "Evénements/incidents dans un établissement ou organisme"
FAMILY_CARE = "Evénements indésirables/graves associés aux soins"
INCIDENT_NATURES = (
    "Acte de prévention",
    "Autre prise en charge",
    "Chute",
    "Disparition inquiétante et fugues (Hors SDRE/SDJ/SDT)",
    "Dispositif médical",
    "Fausse route",
    "Infection associée aux soins (IAS) hors ES",
    "Infection associée aux soins en EMS et ambulatoire (IAS hors ES)",
    "Parcours/Coopération interprofessionnelle",
    "Prise en charge chirurgicale",
    "Prise en charge diagnostique",
    "Prise en charge en urgence",
    "Prise en charge médicamenteuse",
    "Prise en charge des cancers",
    "Prise en charge psychiatrique",
    "Suicide",
    "Tentative de suicide",
)

# Flags, accounting classes, inspection modes, inspection dates.
YES = "Oui"
NO = "Non"
CLASS_ERRD = "ERRD"
CLASS_CA_PA = "CA PA"
CLASS_CA_PH = "CA PH"
MODE_ON_SITE = "Sur site"
MODE_ON_FILE = "Sur pièces"
INSPECTIONS_FROM = "2021-01-01"
INSPECTIONS_CUTOFF = "2023-12-31"

# The configured regions (code, name, short name) and those that take the complaints variant.
REGIONS = (
    (1, "GUADELOUPE", "GUAD"),
    (2, "MARTINIQUE", "MART"),
    (3, "GUYANE", "GUY"),
    (4, "LA REUNION", "REU"),
    (6, "MAYOTTE", "MAY"),
    (11, "ILE DE FRANCE", "IDF"),
    (24, "CENTRE VAL DE LOIRE", "CVL"),
    (27, "BOURGOGNE FRANCHE COMTE", "BFC"),
    (28, "NORMANDIE", "NORM"),
    (32, "HAUTS DE FRANCE", "HDF"),
    (44, "GRAND EST", "GE"),
    (52, "PAYS DE LA LOIRE", "PDL"),
    (53, "BRETAGNE", "BRET"),
    (75, "NOUVELLE AQUITAINE", "NA"),
    (76, "OCCITANIE", "OCC"),
    (84, "AUVERGNE RHONE ALPES", "ARA"),
    (93, "PROVENCE ALPES COTE D AZUR", "PACA"),
    (94, "CORSE", "COR"),
)
COMPLAINT_VARIANT_REGIONS = (32,)

# Files of a source folder that are samples, never data.
SAMPLE_FILES = r"demo.csv|demo.xlsx"

# Texts a delimited source uses for "no value".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Spellings of characters that Unicode decomposition does not turn into ASCII.
ASCII_SPELLINGS = {
    "°": "deg", "œ": "oe", "æ": "ae", "ß": "ss", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "þ": "th", "ı": "i",
    "’": "'", "‘": "'", "“": '"', "”": '"', "«": "<<", "»": ">>", "–": "-", "—": "--", "…": "...", "€": "EUR",
    "×": "x", "÷": "/", "±": "+-",
    # Greek
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "kh", "ψ": "ps", "ω": "o",
    # Cyrillic
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh",
    "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "ё": "io", "ђ": "dj", "ѓ": "gj", "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj", "њ": "nj",
    "ћ": "tsh", "ќ": "kj", "ў": "u", "џ": "dzh",
}

# Report labels in report order, by field id.
LABELS = {
    "region": "Region",
    "dep_code": "Code dép",
    "dep_name": "Département",
    "category": "Catégorie",
    "finess": "FINESS géographique",
    "name": "Raison sociale ET",
    "legal_finess": "FINESS juridique",
    "legal_name": "Raison sociale EJ",
    "legal_status": "Statut juridique",
    "address": "Adresse",
    "postal_code": "Code postal",
    "commune": "Commune",
    "commune_code": "Code commune INSEE",
    "capacity": "Capacité totale autorisée",
    "capacity_hp": "HP Total auto",
    "capacity_aj": "AJ Total auto",
    "capacity_ht": "HT total auto",
    "occupancy_2020": "Taux d'occupation 2020",
    "occupancy_2021": "Taux d'occupation 2021",
    "occupancy_2022": "Taux d'occupation 2022",
    "residents": "Nombre de résidents au 31/12/2022",
    "places_installed": "Nombre de places installées au 31/12/2022",
    "occupancy_q3": "Taux occupation au 31/12/2022",
    "day_price": "Prix de journée hébergement (EHPAD uniquement)",
    "gmp": "GMP",
    "pmp": "PMP",
    "gir_1": "Part de résidents GIR 1 (31/12/2021)",
    "gir_2": "Part de résidents GIR 2 (31/12/2021)",
    "gir_3": "Part de résidents GIR 3 (31/12/2021)",
    "many_drugs": "Part des résidents ayant plus de 10 médicaments consommés par mois",
    "emergency_rate": "Taux de recours aux urgences sans hospitalisation des résidents d'EHPAD",
    "mco_rate": "Taux de recours à l'hospitalisation MCO des résidents d'EHPAD",
    "had_rate": "Taux de recours à l'HAD des résidents d'EHPAD",
    "charges": "Total des charges",
    "tariff_income": "Produits de la tarification",
    "account70_income": "Produits du compte 70",
    "total_income": "Total des produits (hors c/775, 777, 7781 et 78)",
    "dashboard_entry": "Saisie des indicateurs du TDB MS (campagne 2022)",
    "absence_2019": "Taux d'absentéisme 2019",
    "absence_2020": "Taux d'absentéisme 2020",
    "absence_2021": "Taux d'absentéisme 2021",
    "absence_mean": "Absentéisme moyen sur la période 2019-2021",
    "rotation_2019": "Taux de rotation du personnel titulaire 2019",
    "rotation_2020": "Taux de rotation du personnel titulaire 2020",
    "rotation_2021": "Taux de rotation du personnel titulaire 2021",
    "rotation_mean": "Rotation moyenne du personnel sur la période 2019-2021",
    "vacancy_2019": "ETP vacants 2019",
    "vacancy_2020": "ETP vacants 2020",
    "vacancy_2021": "ETP vacants 2021",
    "vacancy_care": "dont fonctions soins 2021",
    "vacancy_education": "dont fonctions socio-éducatives 2021",
    "external_2019": "Taux de prestations externes sur les prestations directes 2019",
    "external_2020": "Taux de prestations externes sur les prestations directes 2020",
    "external_2021": "Taux de prestations externes sur les prestations directes 2021",
    "external_mean": "Taux moyen de prestations externes sur les prestations directes",
    "fte_per_user_2019": "Nombre total d'ETP par usager en 2019",
    "fte_per_user_2020": "Nombre total d'ETP par usager en 2020",
    "fte_per_user_2021": "Nombre total d'ETP par usager en 2021",
    "fte_per_user_mean": "Nombre moyen d'ETP par usager sur la période 2018-2020",
    "care_fte_per_user": "ETP 'soins' par usager en 2021",
    "fte_management": "Direction / Encadrement",
    "fte_management_medical": "dont personnel médical d'encadrement",
    "fte_management_other": "dont autre Direction / Encadrement",
    "fte_administration": "Administration / Gestion",
    "fte_general": "Services généraux",
    "fte_catering": "Restauration",
    "fte_education": "Socio-éducatif",
    "fte_education_amp": "dont AMP",
    "fte_animator": "dont animateur",
    "fte_instructor": "dont moniteur éducateur",
    "fte_specialist": "dont éducateur spécialisé",
    "fte_social_worker": "dont assistant(e) social(e)",
    "fte_education_other": "dont autre socio-éducatif",
    "fte_paramedical": "Paramédical",
    "fte_nurse": "dont infirmier",
    "fte_paramedical_amp": "dont AMP (paramédical)",
    "fte_nursing_aide": "dont aide-soignant(e) ",
    "fte_physiotherapist": "dont kinésithérapeute",
    "fte_psychomotor": "dont psychomotricien(ne)",
    "fte_occupational": "dont ergothérapeute",
    "fte_speech": "dont orthophoniste",
    "fte_paramedical_other": "dont autre paramédical",
    "fte_psychologist": "Psychologue",
    "fte_ash": "ASH",
    "fte_medical": "Médical",
    "fte_coordinator": "dont médecin coordonnateur",
    "fte_medical_other": "dont autre médical",
    "fte_teaching": "Personnel éducation nationale",
    "fte_other": "Autres fonctions",
    "fte_total": "Total du nombre d'ETP",
    "complaints": "Nombre de réclamations sur la période 2018-2022",
    "complaint_rate": "Rapport réclamations / capacité",
    "motif_1": "Recla IGAS : Hôtellerie-locaux-restauration",
    "motif_2": "Recla IGAS : Problème d’organisation ou de fonctionnement de l’établissement ou du service",
    "motif_3": "Recla IGAS : Problème de qualité des soins médicaux",
    "motif_4": "Recla IGAS : Problème de qualité des soins paramédicaux",
    "motif_5": "Recla IGAS : Recherche d’établissement ou d’un professionnel",
    "motif_6": "Recla IGAS : Mise en cause attitude des professionnels",
    "motif_7": "Recla IGAS : Informations et droits des usagers",
    "motif_8": "Recla IGAS : Facturation et honoraires",
    "motif_9": "Recla IGAS : Santé-environnementale",
    "motif_10": "Recla IGAS : Activités d’esthétique réglementées",
    "events": "Nombre d'EI sur la période 36mois",
    "serious_events": "Nombre d'EIG sur la période 2020-2023",
    "flagged": "Nombre de Signalement sur la période 2020-2023",
    "care_events": "Nombre d'EIAS sur la période 2020-2023",
    "all_events": "Somme EI + EIGS + EIAS sur la période 2020-2023",
    "nature_1": "nb EI/EIG : Acte de prévention",
    "nature_2": "nb EI/EIG : Autre prise en charge",
    "nature_3": "nb EI/EIG : Chute",
    "nature_4": "nb EI/EIG : Disparition inquiétante et fugues (Hors SDRE/SDJ/SDT)",
    "nature_5": "nb EI/EIG : Dispositif médical",
    "nature_6": "nb EI/EIG : Fausse route",
    "nature_7": "nb EI/EIG : Infection associée aux soins (IAS) hors ES",
    "nature_8": "nb EI/EIG : Infection associée aux soins en EMS et ambulatoire (IAS hors ES)",
    "nature_9": "nb EI/EIG : Parcours/Coopération interprofessionnelle",
    "nature_10": "nb EI/EIG : Prise en charge chirurgicale",
    "nature_11": "nb EI/EIG : Prise en charge diagnostique",
    "nature_12": "nb EI/EIG : Prise en charge en urgence",
    "nature_13": "nb EI/EIG : Prise en charge médicamenteuse",
    "nature_14": "nb EI/EIG : Prise en charge des cancers",
    "nature_15": "nb EI/EIG : Prise en charge psychiatrique",
    "nature_16": "nb EI/EIG : Suicide",
    "nature_17": "nb EI/EIG : Tentative de suicide",
    "inspections_done": "ICE 2022 (réalisé)",
    "inspections_on_site": "Inspection SUR SITE 2022 - Déjà réalisée",
    "inspections_on_file": "Controle SUR PIECE 2022 - Déjà réalisé",
    "inspections_planned": "Inspection / contrôle Programmé 2023",
}

# Source columns of the yearly staffing dashboards, by field id.
DASHBOARD_RATES = {
    "absence": "taux_dabsenteisme_hors_formation_en_",
    "rotation": "taux_de_rotation_des_personnels",
    "vacancy": "taux_detp_vacants",
    "external": "taux_de_prestations_externes_sur_les_prestations_directes",
}
DASHBOARD_FTE = {
    "fte_management": "etp_directionencadrement",
    "fte_administration": "etp_administration_gestion",
    "fte_general": "etp_services_generaux",
    "fte_catering": "etp_restauration",
    "fte_education": "etp_socio-educatif",
    "fte_paramedical": "etp_paramedical",
    "fte_psychologist": "etp_psychologue",
    "fte_ash": "etp_ash",
    "fte_medical": "etp_medical",
    "fte_teaching": "etp_personnel_education_nationale",
    "fte_other": "etp_autres_fonctions",
}
DASHBOARD_PERSONS = "nombre_de_personnes_accompagnees_dans_leffectif_au_3112"
DASHBOARD_2022_ONLY = {
    "places_installed": "nombre_total_de_chambres_installees_au_3112",
    "gir_1": "personnes_gir_1",
    "gir_2": "personnes_gir_2",
    "gir_3": "personnes_gir_3",
    "vacancy_care": "dont_taux_detp_vacants_concernant_la_fonction_soins",
    "vacancy_education": "dont_taux_detp_vacants_concernant_la_fonction_socio_educative",
    "fte_management_medical": "-_dont_nombre_detp_reels_de_personnel_medical_dencadrement",
    "fte_management_other": "-_dont_autre_directionencadrement",
    "fte_education_amp": "-_dont_nombre_detp_reels_daide_medico-psychologique",
    "fte_animator": "-_dont_nombre_detp_reels_danimateur",
    "fte_instructor": "-_dont_nombre_detp_reels_de_moniteur_educateur_au_3112",
    "fte_specialist": "-_dont_nombre_detp_reels_deducateur_specialise_au_3112",
    "fte_social_worker": "-_dont_nombre_detp_reels_dassistant_social_au_3112",
    "fte_education_other": "-_dont_autre_socio-educatif",
    "fte_nurse": "-_dont_nombre_detp_reels_dinfirmier",
    "fte_paramedical_amp": "-_dont_nombre_detp_reels_daide_medico-psychologique1",
    "fte_nursing_aide": "-_dont_nombre_detp_reels_daide_soignant",
    "fte_physiotherapist": "-_dont_nombre_detp_reels_de_kinesitherapeute",
    "fte_psychomotor": "-_dont_nombre_detp_reels_de_psychomotricien",
    "fte_occupational": "-_dont_nombre_detp_reels_dergotherapeute",
    "fte_speech": "-_dont_nombre_detp_reels_dorthophoniste",
    "fte_paramedical_other": "-_dont_autre_paramedical",
    "fte_coordinator": "-_dont_nombre_detp_reels_de_medecin_coordonnateur",
    "fte_medical_other": "-_dont_autre_medical",
}
