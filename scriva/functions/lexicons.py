"""Word lists, code tables and patterns that decide results. All of them are fixed values."""

from __future__ import annotations

# The 43 output columns in order.
COLUMNS = [
    "RECORD NO", "IMAGE NAME", "CUSTOMER NAME", "EMAIL ADDRESS", "RES_ADDRESS", "CITY_1", "STATE_1", "ZIP_1", "PH_NO1", "COUNTRY_1", "SEX_1",
    "D BIRTH", "HEIGHT", "WEIGHT", "BLOOD GP", "BILLER NAME", "SHIPPER NAME", "CITY_2", "STATE_2", "ZIP_2", "COUNTRY_2", "PH_NO2", "ALCOHOLIC",
    "SMOKER", "PAST SURG", "DIABETIC", "ALLERGIESED", "POLICY NO", "D_B_LIFE_ASSURE", "P_INST", "NAME_P_HOLDER", "STM NAME", "STM CODE", "DOB",
    "SEX_2", "CARD NAME", "MEDICINE", "DOSAGE", "TABLETS", "PILL RATE", "COST", "SHIPPING CO", "TOTAL AMT",
]
MANDATORY = [c for c in COLUMNS if c != "IMAGE NAME"]

# States.
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO",
    "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
# Cities of several words, as the extractor and as the recovery know them.
CITIES = ["south jordan", "west jordan", "west valley city", "salt lake city", "san benito", "round rock"]
CITIES_RECOVERY = ["south jordan", "west jordan", "west valley city", "salt lake city", "san benito", "round rock", "west valley", "lake city"]

# Medicines that are valid, and one more spelling that is only looked for.
MEDICINES = [
    "PHENTERMINE", "DIAZEPAM", "XANAX", "VALIUM", "ADIPEX", "MERIDIA", "BONTRIL", "IONAMIN", "FASTIN", "PONDIMIN", "REDUX", "ZANTREX", "AMBIEN",
    "LUNESTA", "HALCION", "RESTORIL", "SONATA", "CELEBREX", "VIOXX", "MORPHINE", "OXYCONTIN", "PERCOCET", "VICODIN", "TYLENOL", "IBUPROFEN",
    "ASPIRIN", "NAPROXEN", "DIDREX", "ZOLOFT", "CLONAZEPAM", "CLONAZAPAM",
]
MEDICINES_SOUGHT = [
    "PHENTERMINE", "DIAZEPAM", "XANAX", "VALIUM", "ADIPEX", "MERIDIA", "BONTRIL", "IONAMIN", "FASTIN", "PONDIMIN", "REDUX", "ZANTREX", "AMBIEN",
    "AMBIENR", "LUNESTA", "HALCION", "RESTORIL", "SONATA", "CELEBREX", "VIOXX", "MORPHINE", "OXYCONTIN", "PERCOCET", "VICODIN", "TYLENOL", "IBUPROFEN",
    "ASPIRIN", "NAPROXEN", "DIDREX", "ZOLOFT", "CLONAZEPAM", "CLONAZAPAM",
]
# Usual doses.
DOSES = {"DIAZEPAM": "0.25MG", "PHENTERMINE": "37.5MG", "XANAX": "0.25MG", "VALIUM": "1MG", "AMBIEN": "10MG", "ADIPEX": "37.5MG", "MERIDIA": "15MG"}
# Words that open the medication section.
CARD_WORDS = [
    "VISA", "V1SA", "VI5A", "VIGA", "VIS4", "V1S4", "MASTER", "MASTERCARD", "MC ", " AMEX", "AMERICAN EXPRESS", "AMERICANEXPRESS", "DISCOVER",
    "DISC0VER", "DISCOVERR", "RETAIL", "RETALL", "RETAL", "GAS", "BANK", "OTHER", "OTHAR",
]
# Cards and the patterns that name them, in order.
CARDS = [
    ("American Express", r"(?i)\bAmerican\s*Express(?:\b|(?=[A-Z]))"),
    ("Visa", r"(?i)\b(?:Visa|V1sa|Viga|Vi5a)\b"),
    ("MasterCard", r"(?i)\bMaster\s*(?:Card|C4rd|Cerd)\b"),
    ("Discover", r"(?i)\b(?:Dis\s*cover|Disc\s*0ver|Die\s*cover)\b"),
    ("Retail", r"(?i)\b(?:Retail|Retall|Retal)\b"),
    ("Gas", r"(?i)\bGas\b"),
    ("Bank", r"(?i)\bBank\b"),
    ("Other", r"(?i)\b(?:Others?|0thers?|Othar|Othe[r]?|0the[r]?|Othes)\b"),
]
# Substrings that name a card in the recovery, in order.
CARD_TRACES = [
    ("Visa", ["visa", "v1s", "v15", "vi5", "viga"]), ("MasterCard", ["master", "mc"]), ("Discover", ["discover", "disc"]),
    ("American Express", ["american", "express", "amex"]), ("Retail", ["retail"]), ("Gas", ["gas"]), ("Bank", ["bank"]),
]
# Mail domains as read and as meant, and unfinished ones.
DOMAINS = [
    ("netzero.net", "netzero.net"), ("usa.net", "usa.net"), ("aol.com", "aol.com"), ("acl.com", "aol.com"), ("ac1.com", "aol.com"), ("a0l.com", "aol.com"),
    ("hotmail.com", "hotmail.com"), ("attgloba.net", "attgloba.net"), ("comcast.net", "comcast.net"), ("gmail.com", "gmail.com"),
    ("bellatlantic.net", "bellatlantic.net"), ("visto.com", "visto.com"),
]
DOMAIN_ENDS = [("aol", "aol.com"), ("alltel", "alltel.net"), ("hotmail", "hotmail.com"), ("gmail", "gmail.com"), ("netzero", "netzero.net"), ("usa", "usa.net")]
# Repairs of truncated and misread domains in the recovery, in order.
MAIL_REPAIRS = [
    (r"[,;]\s*([a-zA-Z]{2,4})$", ".$1"),
    (r"(?i)@yah[o0OcC]{0,2}$", "@yahoo.com"), (r"(?i)@gma[iI1l]{0,2}$", "@gmail.com"), (r"(?i)@hot[mNnaA]{0,2}a?[iI1l]?[lI1]?$", "@hotmail.com"),
    (r"(?i)@netzer[o0O]?$", "@netzero.net"), (r"(?i)@gma[iI1l][lI1]\.", "@gmail."), (r"(?i)@gma[iI1l][lI1]com$", "@gmail.com"),
    (r"(?i)@yah[o0OcC]{2}\.", "@yahoo."), (r"(?i)@hot[mNnaA]{1,2}a[iI1l][lI1]\.", "@hotmail."), (r"(?i)@netzer[o0O]\.", "@netzero."),
    *((rf"(?i)@{a}$", f"@{b}") for a, b in DOMAIN_ENDS),
]
# First names by which the recovery tells the sex.
FEMALE = [
    "carol", "catherine", "michelle", "sally", "linda", "patricia", "mary", "elizabeth", "jennifer", "barbara", "susan", "jessica", "sarah", "karen", "lisa", "nancy",
    "betty", "margaret", "sandra", "ashley", "dorothy", "kimberly", "emily", "donna", "ruth", "sharon", "laura", "helen", "amy", "anna", "brenda", "virginia",
    "shirley", "kathleen", "pamela", "angela", "rose", "tillie", "woo", "julia", "marie", "diane", "joyce", "evelyn", "cheryl",
]
MALE = [
    "robert", "john", "david", "james", "peter", "william", "dennis", "charles", "thomas", "michael", "richard", "joseph", "george", "edward", "ronald", "donald",
    "kenneth", "steven", "timothy", "brian", "kevin", "mark", "daniel", "paul", "gary", "larry", "jeffrey", "frank", "scott", "eric", "stephen", "andrew",
    "raymond", "gregory", "joshua", "jerry", "walter", "patrick", "harold", "henry", "arthur", "ryan", "albert", "bruce", "willie", "howard", "fred", "ralph",
    "chris", "percell", "clayton", "harry", "juan", "jose", "luis",
]
# Lines that are dropped, blood groups, causes of review, tablet counts.
AVAILABLE = ["available", "not available", "notavailable", "availabe", "avalabe", "avalable"]
BLOOD_GROUPS = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
TABLET_COUNTS = [30, 50, 60, 90, 120, 180]
CAUSES = [
    ("ZIP", "zip_missing"), ("ZIP_2", "zip_2_missing"), ("BLOOD", "blood_group_error"), ("SHIPPER", "shipper_name_corruption"),
    ("POLICY", "policy_holder_parse"), ("DOB", "date_parse"), ("D BIRTH", "date_parse"), ("EMAIL", "email_parse"), ("PH_NO", "phone_parse"),
    ("PHONE", "phone_parse"),
]
# The fallback's section and line of each field.
FALLBACK = {
    "RECORD NO": ("customer", 0),
    "CUSTOMER NAME": ("customer", 0),
    "BILLER NAME": ("customer", 0),
    "EMAIL ADDRESS": ("customer", 1),
    "RES_ADDRESS": ("customer", 2),
    "CITY_1": ("customer", 3),
    "STATE_1": ("customer", 3),
    "ZIP_1": ("customer", 3),
    "PH_NO1": ("customer", 3),
    "COUNTRY_1": ("customer", 4),
    "SEX_1": ("customer", 4),
    "D BIRTH": ("customer", 4),
    "HEIGHT": ("customer", 5),
    "WEIGHT": ("customer", 5),
    "BLOOD GP": ("customer", 5),
    "SHIPPER NAME": ("shipper", 0),
    "CITY_2": ("shipper", 1),
    "STATE_2": ("shipper", 1),
    "ZIP_2": ("shipper", 1),
    "COUNTRY_2": ("shipper", 1),
    "PH_NO2": ("shipper", 2),
    "ALCOHOLIC": ("shipper", 2),
    "SMOKER": ("shipper", 2),
    "PAST SURG": ("shipper", 2),
    "DIABETIC": ("shipper", 2),
    "ALLERGIESED": ("shipper", 2),
    "POLICY NO": ("policy", 0),
    "D_B_LIFE_ASSURE": ("policy", 0),
    "P_INST": ("policy", 0),
    "NAME_P_HOLDER": ("policy", 1),
    "STM NAME": ("policy", 1),
    "STM CODE": ("policy", 1),
    "DOB": ("policy", 2),
    "SEX_2": ("policy", 2),
    "CARD NAME": ("medication", 0),
    "MEDICINE": ("medication", 0),
    "DOSAGE": ("medication", 0),
    "TABLETS": ("medication", 0),
    "PILL RATE": ("medication", 1),
    "COST": ("medication", 1),
    "SHIPPING CO": ("medication", 1),
    "TOTAL AMT": ("medication", 1),
}
# How digits are read as letters and letters as digits.
DIGITS_TO_LETTERS = ("40152867", "AOISZBGT")
STATE_DIGITS = ("410258", "AAOZSB")
CODE_LETTERS = ("IliOoSsZzBbGgTtAa", "11100552288667744")
# Patterns.
EMAIL = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
ZIP = r"\b(\d{5})\b"
PHONE = r"\(?\d{3}\)?\s*-?\d{3}-?\d{4}"
DATE = r"\b(\d{2}/\d{2}/\d{2,4})\b"
MONEY = r"\$?\s*(\d+\.\d{2})"
STAMP = r"\b([BSbs5]aX)[\s_.\-]*([a-zA-Z0-9_\-.]+?)[\s_.\-]*([a-zA-Z0-9]{5})\b"
POLICY = r"\b(?:SR|5R|sR|Sr)[_0-9a-zA-Z-]*\b"
BLOOD = r"(?<!\w)(AB\s*[+\-]|[ABO0]\s*[+\-])(?!\w)"
# What the recovery and the readers of single fields go by.
TITLES = ["mr", "mrs", "ms", "dr", "iii", "ii"]
YES = ["YES", "YE5", "Y1S"]
NO = ["NO", "N0", "NOI", "INO", "N0I"]
#: What a policy holder's name is cleared of, in order.
HOLDER_NOISE = [
    r"\b\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4}\b",
    r"\$?\s*\b\d+\.\d{2}\b",
    r"\b(?:SR|5R|sR|Sr)[_0-9a-zA-Z-]*\b",
    r"(?i)\b[BSbs5]aX[\s_.\-]*[a-zA-Z0-9_\-.]*?\s*[a-zA-Z0-9]{5}\b",
    r"(?i)\S+@\S+|\S+(?:HOTMAIL|GMAIL|AOL|YAHOO|NETZERO|COMCAST)\S*",
    r"(?i)\S+\.(?:COM|NET|ORG|c[o0]m|ne[t1])\b",
]
#: Scores of a five-digit run as the record number: at first, behind a state, behind a stamp, at the start of a line, before a name.
RECORD_SCORES = {"start": 100, "state": -80, "stamp": -50, "first": 20, "name": 10}
BEHIND_STATE = r"\b([A-Za-z]{2})\b\s*$"
BEHIND_STAMP = r"(?i)[BSbs5]aX[\s_.\-]*[a-zA-Z0-9_]*\s*$"
NOT_A_NAME = "@ |INC|CO|LANE|DRIVE|ROAD|STREET"
GENDER = [("FEMALE", r"\b(FEMALE|FEMAL|FEMELE|FEMEL)\b|FEMALE"), ("MALE", r"\bMAL\b|MALE")]
DOSE = r"(?i)(?<![\w.])(\d*\.?\d+\s*MG)\b"
PART_OF_DOSE = r"(?i)([\d.]+)\s*(?=MG\b)"
GLUED_DOSE, GLUED_PRICES = r"(\d+(?:\.\d+)?\s*MG)", r"(\$\d+\.\d{2})(\$)"
TEN_DIGITS = r"\b[Ss\d]\d{2}[-.\s]?\d{3}[-.\s]?\d{4}\b"
BLOOD_LETTERS = {"O": ["C", "G", "Q", "0", "O"], "B": ["8", "6", "E"]}
# Patterns of the normalisation.
DIV0 = r"(?i)#\s*DIV\s*/?\s*0\s*!?\s*"
ZIP_COUNTRY = r"\b(\d{5})([A-Za-z]{2,})\b"
ZIP_PHONE = r"\b(\d{5})(\d{3}\s*-?\s*\d{3}-?\d{4})\b"
GLUED_MG, GLUED_DIGITS = r"(?i)([A-Za-z])(?=\d+(?:\.\d+)?\s*MG\b)", r"([A-Za-z]{2,})(?=\d)"
LOOSE_SIGNS = [(r"\s+([,.:;\-])", "$1"), (r"(\$)\s+", "$1")]
DATE_GAPS = [(r"\b(\d)\s+(\d/\d{1,2}/\d{2,4})\b", "$1$2"), (r"\b(\d{1,2}/\d)\s+(\d/\d{2,4})\b", "$1$2"), (r"(\d)\s*/\s*(\d)", "$1/$2")]
DATE_EDGES = [(r"([^\s\d/])(?=\d{1,2}/\d{1,2}/\d{2,4}(?!\d))", "$1 "), (r"(?<![\d/])(\d{1,2}/\d{1,2}/\d{2,4})(?=[^\s\d/])", "$1 ")]


def field(column: str) -> str:
    """The name by which plans know an output column."""
    return column.lower().replace(" ", "_")


FIELDS = [field(c) for c in COLUMNS]
