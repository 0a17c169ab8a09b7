"""These must stay as they are for results to match what users expect."""

# Column types of an API long table; a file holds any subset of these columns.
API_COLUMN_TYPES = {
    "id": "string",
    "ResourceID": "string",
    "TimeSeriesID": "string",
    "Period": "date",
    "Duration": "string",
    "Value": "double",
    "Unit": "string",
    "Multiplier": "double",
    "NullReason": "string",
    "Status": "string",
    "Code1": "string",
    "Label1": "string",
    "Code2": "string",
    "Label2": "string",
    "Code3": "string",
    "Label3": "string",
    "Code4": "string",
    "Label4": "string",
    "Code5": "string",
    "Label5": "string",
    "Code6": "string",
    "Label6": "string",
}
MAX_LABEL_LEVELS = 6

# Text of a missing cell, and the status of a cell without one.
MISSING_CELL = ".."
DEFAULT_STATUS = "F"
# Statuses kept by the optional filter on missing values.
SUPPRESSED_STATUSES = ("C", "S")

LABEL_SEPARATOR = "__"

# Most cells that one request may hold; the title that is split to stay below it.
CELLS_PER_REQUEST = 50_000
CHUNK_TITLE = "Time"

# Release watch.
DEFAULT_ZONE = "Pacific/Auckland"
CHECK_EVERY_MINUTES = 5
WATCH_MINUTES = 30
USUAL_RELEASE_TIME = "10:45:00"
DATE_PLACEHOLDER = "<date_str>"

# Zone names that calendar programs write, and their regions.
CALENDAR_ZONES = {
    "New Zealand Standard Time": "Pacific/Auckland",
    "AUS Eastern Standard Time": "Australia/Sydney",
    "GMT Standard Time": "Europe/London",
    "W. Europe Standard Time": "Europe/Berlin",
    "Romance Standard Time": "Europe/Paris",
    "Eastern Standard Time": "America/New_York",
    "Central Standard Time": "America/Chicago",
    "Mountain Standard Time": "America/Denver",
    "Pacific Standard Time": "America/Los_Angeles",
    "Tokyo Standard Time": "Asia/Tokyo",
    "Singapore Standard Time": "Asia/Singapore",
    "India Standard Time": "Asia/Kolkata",
    "Greenwich Standard Time": "Atlantic/Reykjavik",
}

# Messages of a page check that could not be made.
TEMPLATE_ERROR = "text_template must contain exactly one '<date_str>' substring"
SELECTOR_ERROR = "Exactly one of xpath or css must be specified"
NOT_FOUND_ERROR = "Could not find HTML element according to "
TEMPLATE_MISMATCH_ERROR = "text_template is not valid for the HTML element"

# Alert subjects.
SUBJECT_PREFIX = "Alert"
RELEASED_SUBJECT = "Data Release Detected"
RELEASE_ERROR_SUBJECT = "Data Release Error"

# Gas delivery points and the meters read at each.
POINT_METERS = {
    "EGC30701": ["30701", "30703"],
    "KUR33601": ["33601"],
    "LCF20010": ["20001"],
    "LCF20011": ["20021", "20022"],
    "MRV16301": ["16301"],
    "MUT19001": ["19001"],
    "PHT04902": ["4921"],
    "TAC31001": ["9931003"],
    "TIR33501": ["33501"],
    "GLB03401": ["3401", "3402"],
    "KIN04310": ["4301", "4302"],
    "MSD01801": ["1801", "1803"],
    "STR00521": ["521", "522"],
    "TCC00201": ["201", "202"],
    "TRC02003": ["2003", "2004"],
}
