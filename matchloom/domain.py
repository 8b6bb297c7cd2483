"""Fixed values of the domain: they must be equal everywhere, so they are here once."""

from __future__ import annotations

# Participants 1-5 play blue, 6-10 red.
BLUE_KEYS = ("1", "2", "3", "4", "5")
RED_KEYS = ("6", "7", "8", "9", "10")

BLUE_TEAM = 100
RED_TEAM = 200

# Raw position names.
POSITIONS = ("TOP", "JUNGLE", "MIDDLE", "BOTTOM", "UTILITY")

# Roles of the reports.
ROLES = ("TOP", "JNG", "MID", "BOT", "SUP")

# Role by keyword anywhere in a feature name. The order counts: first hit wins.
ROLE_KEYWORDS = (
    ("TOP", ("TOP",)),
    ("JNG", ("JNG", "JUNGLE")),
    ("MID", ("MID", "MIDDLE")),
    ("BOT", ("BOT", "BOTTOM", "ADC")),
    ("SUP", ("SUP", "UTILITY", "SUPPORT")),
)

# Label column of a position in the per-position models.
POSITION_LABELS = {
    "TOP": "TOP_LABEL",
    "JUNGLE": "JUNGLE_LABEL",
    "MIDDLE": "MID_LABEL",
    "BOTTOM": "ADC_LABEL",
    "UTILITY": "SUP_LABEL",
}

# Columns of the player view that are not features.
NOT_FEATURES = ("DS", "MATCHID", "TEAMID", "PARTICIPANTID", "WIN")
NOT_FEATURES_PER_POSITION = (*NOT_FEATURES, *POSITION_LABELS.values(), "TEAMPOSITION")

# Difference features counted for a role in the averaged report.
LISTED_FEATURES = {
    "TOP": ("TOP_SOLOKILLS_DIF", "TOP_PLATES_DIF", "TOP_KILLS_DIF"),
    "JNG": (
        "JUNGLE_DRAGON_DIF",
        "JUNGLE_GOLD_RATE_DIF",
        "JUNGLE_KILLPARTICIPATION_DIF",
        "JUNGLE_RIFTHERALD_DIF",
        "JUNGLE_BARONKILLS_DIF",
    ),
    "MID": ("MID_KILLPARTICIPATION_DIF", "MID_KILLS_DIF", "MID_DAMAGE_RATE_DIF"),
    "BOT": (
        "BOTTOM_DAMAGE_RATE_DIF",
        "BOTTOM_GOLD_RATE_DIF",
        "BOTTOM_KILLPARTICIPATION_DIF",
    ),
    "SUP": (
        "SUP_EFFECTIVEHEALANDSHIELDING_DIF",
        "SUP_CC_RATE_DIF",
        "SUP_VISION_PER_MIN_DIF",
        "SUP_DAMAGE_RATE_DIF",
        "SUP_KILLPARTICIPATION_DIF",
        "SUP_WARDS_PM_DIF",
    ),
}

UNKNOWN_MATCH = "UNKNOWN_MATCH"
FRAME_TOPIC = "timeline.frames"

# Endings taken off an account host.
HOST_ENDINGS = (".snowflakecomputing.com", ".aws")

SECRET_MARK = "PASS"
SECRET_MASK = "***"
