"""Names, labels and lookup tables that results must agree with.

Everything in this file is a fixed value: survey and question codes, French
labels as they are stored, and the small tables that map one to another.
Project labels and public addresses are no part of it; they are arguments.
"""

# --- places ---------------------------------------------------------------

TOP_PLACE = "Régional"

COUNTRY_OF_CODE = {
    "BF": "Burkina-Faso",
    "MR": "Mauritanie",
    "SN": "Sénégal",
    "ML": "Mali",
    "REGIONAL": "Régional",
    "NE": "Niger",
    "TD": "Tchad",
}

#: the same with the spellings that occur in sheets only
COUNTRY_OF_SHEET_CODE = {
    "BF": "Burkina-Faso",
    "MR": "Mauritanie",
    "MR Restruct*": "Mauritanie (restructuré)",
    "NE": "Niger",
    "ML": "Mali",
    "SN": "Sénégal",
    "TD": "Tchad",
    "REGIONAL": "Régional",
    "REGIONAL restruc": "Régional (restructuré)",
}

#: order of the countries in the report
REPORT_COUNTRIES = (
    ("Burkina-Faso", "BF"),
    ("Mali", "ML"),
    ("Mauritanie", "MR"),
    ("Niger", "NE"),
    ("Sénégal", "SN"),
    ("Tchad", "TD"),
    ("Régional", "REGIONAL"),
)

# --- surveys --------------------------------------------------------------

COUNTRY_SURVEY = "indicateurs_pays"
REGIONAL_SURVEY = "indicateurs_regionaux"

SURVEYS = (
    "indicateurs_regionaux",
    "indicateurs_pays",
    "marches_a_betail",
    "parcs_de_vaccination",
    "points_d_eau",
    "unites_veterinaires",
    "fourrage_cultive",
    "sous_projets_innovants",
    "gestion_durable_des_paysages",
    "activites_generatrices_de_revenus",
)

#: question code of each place, from country to locality and point
PLACE_QUESTIONS = {
    "marches_a_betail": ("LMB1", "LMB2", "LMB3", "LMB4", "LMB5", "LMB6"),
    "parcs_de_vaccination": ("LVAC1", "LVAC2", "LVAC3", "LVAC4", "LVAC5", "LVAC6"),
    "points_d_eau": ("LPE1", "LPE2", "LPE3", "LPE4", "LPE5", "LPE7"),
    "unites_veterinaires": ("LUV1", "LUV2", "LUV3", "LUV4", "LUV5", "LUV6"),
    "fourrage_cultive": ("LFC1", "LFC2", "LFC3", "LFC4", "LFC5", "LFC6"),
    "sous_projets_innovants": ("LINO1", "LINO2", "LINO3", "LINO4", "LINO5", "LINO6"),
    "gestion_durable_des_paysages": ("LODURA1", "LODURA2", "LODURA3", "LODURA4", "LODURA5", "LODURA6"),
    "activites_generatrices_de_revenus": ("LAGR1", "LAGR2", "LAGR3", "LAGR4", "LAGR5", "LAGR6"),
}

STATE_QUESTION = {
    "marches_a_betail": "STMB5",
    "parcs_de_vaccination": "STVAC5",
    "points_d_eau": "STPE5",
    "unites_veterinaires": "STUV5",
}

PROGRESS_QUESTION = {
    "marches_a_betail": "STMB15",
    "parcs_de_vaccination": "STVAC15",
    "points_d_eau": "STPE15",
    "unites_veterinaires": "STUV15",
}

#: stem of the four picture questions; the letters a to d follow
PICTURE_STEM = {
    "marches_a_betail": "LMB7",
    "parcs_de_vaccination": "LVAC8",
    "points_d_eau": "LPE8",
    "unites_veterinaires": "LUV7",
    "fourrage_cultive": "LFC7",
    "gestion_durable_des_paysages": "LODURA7",
    "activites_generatrices_de_revenus": "LAGR7",
    "sous_projets_innovants": "LINO7",
}

# --- answers --------------------------------------------------------------

YES = "Oui"
STATE_PROVISIONAL = "Réception provisoire sans réserve"
STATE_FINAL = "Réception définitive"
OFFICES = ("Président (e)", "Sécrétaire (principal-e)", "Trésorier (ère)")
WOMEN_SHARE = 0.15

# --- history --------------------------------------------------------------

#: codes whose historical values are percentages from 0 to 100
HISTORY_PERCENT_CODES = ("IR-1", "IRI-17", "IRI-1", "IRI-9", "Reg Int 7")

# --- metadata notes -------------------------------------------------------

NOTE_NEW_CODE = "nouveau code d'indicateur"
NOTES_CHANGED = ("indicateur supprimé", "indicateur changé")

# --- sheets ---------------------------------------------------------------

TITLE_ROWS = 4

SHEET_2025_COLUMNS = {
    "indicator_code_original": "column_1",
    "indicator_name_original": "column_2",
    "unit_original": "column_4",
    "country": "column_5",
    "target_value": "column_7",
    "result_value": "column_8",
}

SHEET_2026_COLUMNS = {
    "indicator_code_original": "column_1",
    "indicator_name_original": "column_2",
    "unit_original": "column_4",
    "country": "column_5",
    "target_value_2021": "column_6",
    "target_value_2022": "column_7",
    "target_value_2023": "column_8",
    "target_value_2024": "column_9",
    "target_value_2026": "column_10",
    "target_value_2027": "column_11",
}

RESULT_HEADER = "Résultats"
TOTAL_LABEL = "Total"
RESTRUCTURED = "restruc"

REGIONAL_CODES = (
    "Reg Int 1",
    "Reg Int 2",
    "Reg Int 3",
    "Reg Int 4",
    "Reg Int 5",
    "Reg Int 6",
    "Reg Int 7",
)

#: country of 2025 rows that name none: by code and value, then by code, then the last
BLANK_COUNTRY_BY_VALUE = (("6", (185, 107), "MR"), ("7", (5576, 3509), "MR"))
BLANK_COUNTRY_BY_CODE = {"FA 2": "BF"}
BLANK_COUNTRY_REGIONAL = "REGIONAL"
BLANK_COUNTRY_ELSE = "NE"

CODE_OF_NAME = {
    "Niveau de mise en œuvre des Plans Nationaux Stratégiques (PNS) pour la PPR et la PPCB": "IRI-1",
    "Points d’eau fonctionnels accessibles aux (agro)pasteurs sur les axes de déplacement et sur les nouveaux parcours de transhumance appuyés par le projet": "IRI-6",
    "Fourrage cultivé produit et disponible aux pasteurs et agro-pasteurs grâce au projet ": "IRI-7",
    "Marchés opérationnels selon des critères définis réhabilités et construits grâce au projet le long des couloirs régionaux": "IRI-8",
    "Femmes et jeunes issus du milieu pastoral ayant bénéficié de programmes de formation technique et professionnelle ou de formation qualifiante": "IRI-11",
    "Cadres techniques et scientifiques formés sur le pastoralisme (y compris formations diplomantes)": "IRI-14",
}

COMPONENT_CODES = {
    "ODP": ["IR-1", "IR-2", "IR-3", "IR-4"],
    "1": ["IRI-1", "IRI-2", "IRI-3", "IRI-4"],
    "2": ["IRI-5", "IRI-6", "IRI-7", "FA-1"],
    "3": ["IRI-8", "IRI-9", "IRI-10", "IRI-101", "IRI-102", "IRI-103", "FA-2", "FA-21", "FA-22"],
    "4": ["IRI-11", "IRI-111", "IRI-112", "IRI-113", "IRI-12", "IRI-13", "IRI-131", "IRI-132", "IRI-133"],
    "5": [
        "IRI-14", "IRI-141", "IRI-15", "IRI-16", "IRI-17", "IRI-171", "IRI-18", "IRI-181",
        "FA-3", "FA-31", "FA-32", "FA-33", "FA-4",
    ],
    "Reg": list(REGIONAL_CODES),
}

UNIT_LABELS = {
    "Ha (valeur cumulée)": "Ha (cumulé)",
    "hectares (milliers, valeur cumulée)": "Milliers d’ha (cumulé)",
    "nombre": "Nombre",
    "nombre (valeur cumulée)": "Nombre (valeur cumulée)",
    "nombre d'études (valeur cumulée)": "Nombre d'études (valeur cumulée)",
    "nombre de pays et institutions (valeur cumulée)": "Nombre de pays et institutions (valeur cumulée)",
    "nombre de sessions par an": "Nombre de sessions par an",
    "oui / non": "Oui/Non",
    "pourcentage": "Pourcentage",
    "tonnes (valeur cumulée)": "Tonnes (cumulé)",
}

INDICATOR_TYPES = {
    "percent": "Pourcentage",
    "count": "Nombre",
    "surface": "Nombre",
    "weight": "Nombre",
    "boolean": "Oui/Non",
}

# --- report ---------------------------------------------------------------

REPORT_YEARS = (2022, 2023, 2024, 2025, 2026, 2027)
REPORT_PERCENT_UNIT = "Pourcentage"

#: section, its label, and its components with their codes, in order
REPORT_LAYOUT = (
    (
        "ODP",
        "Indicateurs ODP par objectif/résultat",
        (
            ("Actifs soutenus et maintenus", ("IR-1", "IR-2")),
            ("Ecosystèmes soutenus et maintenus", ("IR-3",)),
            ("Moyens soutenus et maintenus", ("IR-4",)),
        ),
    ),
    (
        "IRI",
        "Indicateurs de résultats intermédiaires par composante",
        (
            (
                "Amélioration de la santé animale et contrôle des médicaments vétérinaires",
                ("IRI-1", "IRI-2", "IRI-3", "IRI-4", "Reg Int 1"),
            ),
            (
                "Gestion durable des paysages et amélioration de la gouvernance",
                ("IRI-5", "IRI-6", "IRI-7", "IRI-FA", "Reg Int 2", "Reg Int 3"),
            ),
            (
                "Amélioration des chaînes de valeur du bétail",
                ("IRI-8", "IRI-9", "IRI-10", "IRI-101", "IRI-102", "IRI-103", "Reg Int 4"),
            ),
            (
                "Amélioration de l'inclusion sociale et économique, femmes et jeunes",
                ("IRI-11", "IRI-111", "IRI-112", "IRI-113", "IRI-12"),
            ),
            (
                "Amélioration de l'inclusion sociale et économique, femmes et jeunes (suite)",
                ("IRI-13", "IRI-131", "IRI-132", "IRI-133"),
            ),
            (
                "Coordination de projet, renforcement institutionnel, et prévention et réponse aux urgences",
                ("IRI-14", "IRI-141", "IRI-15", "IRI-16", "IRI-17"),
            ),
            (
                "Coordination de projet, renforcement institutionnel, et prévention et réponse aux urgences (suite)",
                ("IRI-18", "IRI-181", "IRI-19", "Reg Int 5", "Reg Int 6", "Reg Int 7"),
            ),
        ),
    ),
)

# --- attachments ----------------------------------------------------------

PLACEHOLDER_PICTURE = "placeholder.png"
PICTURE_EXTENSIONS = ("jpg", "jpeg", "png")
