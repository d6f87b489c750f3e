"""Schemas, keys and code lists of the contract and client tables."""

from __future__ import annotations

# ---- fixed values: column names, types, code lists and labels -------------

CONTRACT_SCHEMA = """
nusoc INT, nucon INT, cateco STRING,
g01co INT, g02co INT, g03co INT, g04co INT, g05co INT, g06co INT, g09co INT, g10co INT, g13co INT, g15co INT,
g16co INT, g17co INT, g18co INT, g19co INT, g21co INT, g22co INT, g23co INT, g25co INT, g26co INT, g28co INT,
clasco STRING, tar6co STRING, bomaco DOUBLE, fracco STRING, famgta STRING, markli STRING, apcoco STRING,
acircu INT, mcircu INT, acreco INT, mcreco INT, jcreco INT,
prmaco DOUBLE, etatco STRING, asaico INT, msaico INT, jsaico INT, utimot STRING, pfco INT, usagco1 INT
"""

CLIENT_SCHEMA = """
nusoc INT, cdepso STRING, cvilso STRING, sexsoc STRING, bgesso STRING,
aadhso INT, anaiso INT, mnaiso INT, jnaiso INT, cspsoc STRING, asaiso STRING, msaico INT, jsaiso INT,
sitmat STRING, nbenf INT, accmai STRING, accsms STRING, sitpav1 STRING
"""

GUARANTEE_FLAGS = (
    "g01co g02co g03co g04co g05co g06co g09co g10co g13co g15co "
    "g16co g17co g18co g19co g21co g22co g23co g25co g26co g28co"
).split()

VEHICLE_TYPES = {"A": "Auto", "M": "Moto", "C": "Cyclo"}
VEHICLE_TYPE_OTHER = "Inconnu"

CONTRACT_STATES = {
    "0": "Annule",
    "1": "En cours",
    "2": "Suspendu",
    "3": "Resilie societaire",
    "4": "Resilie impaye",
    "7": "Resilie article 25",
    "9": "Resilie Mutuelle",
}
CONTRACT_STATE_OTHER = "Autre"
CONTRACT_STATE_MISSING = "UNKNOWN"
CONTRACT_STATE_ACTIVE = "1"

VEHICLE_USES = {0: "Domicile-Travail", 1: "Promenade", 3: "Professionnel"}
VEHICLE_USE_OTHER = "Autre"

AGE_SEGMENTS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
AGE_SEGMENT_LAST = "65+"
YOUNG_CLIENT_BELOW = 30

CLIENT_ATTRIBUTES = ["sexsoc", "aadhso", "cspsoc", "sitmat", "sitpav1", "nbenf"]
PROFILE_COLUMNS = ["nusoc", "age_client", "client_jeune", "sexsoc", "cspsoc", "sitmat", "sitpav1"]

JOB_DURATION_BOUNDS = [30, 60, 120, 300, 600, 1800, 3600]
STORAGE_DURATION_BOUNDS = [1, 5, 10, 30, 60, 300]

# ---- end of fixed values ---------------------------------------------------


def schema_types(ddl: str) -> dict[str, str]:
    """Column names and types, in order, of one of the schemas above."""
    return dict(column.lower().split() for column in ddl.split(","))


CONTRACT_KEY = ["nusoc", "nucon"]
CLIENT_KEY = "nusoc"

# Types the silver layer forces, whatever the bronze files carry.
CONTRACT_CASTS = {"nusoc": "int", "nucon": "int", "prmaco": "double", "pfco": "int", "asaico": "int"}
CONTRACT_DEFAULTS = {"pfco": 0, "etatco": CONTRACT_STATE_MISSING, "prmaco": 0.0}

# Landing files of one bronze run: dataset, file, schema.
BRONZE_DATASETS = [
    ("Contrat2", "Contrat2.csv", CONTRACT_SCHEMA),
    ("Contrat1", "Contrat1.csv", CONTRACT_SCHEMA),
    ("Client", "Client.csv", CLIENT_SCHEMA),
]
SILVER_DATASET = "Client_contrat_silver"
