"""Dictionaries, weights and times to live."""

# They decide the results and the label names, so they are given as they are.

# Long business code of a click or exposure -> short business name.
BIZ_OF_MODEL = {
    "terminalModel": "terminal",
    "broadbandModel": "broadband",
    "packageModel": "package",
    "cardModel": "number",
    "familyModel": "family",
    "xiaomiModel": "xiaomi",
}

# The interest score knows the first five businesses only, in this order.
SCORED_BIZ = ["terminal", "broadband", "package", "number", "family"]
SCORED_BIZ_OF_MODEL = {m: b for m, b in BIZ_OF_MODEL.items() if b in SCORED_BIZ}
EXPOSED_BIZ = SCORED_BIZ + ["xiaomi"]

# Order in which equally exposed businesses come out. "number" and "xiaomi" share the first
# place; which of the two leads depends on the queue (see operators.exposure).
EXPOSED_ORDER = ["number", "xiaomi", "package", "broadband", "terminal", "family"]

NUMBER_TYPE_OF_CODE = {
    "01": "birthday",
    "02": "family",
    "03": "lucky",
    "04": "love",
    "05": "student",
    "06": "rare",
    "09": "bless",
    "12": "area",
}

CARD_MODEL = "cardModel"
NUMBER_BIZ = "number"
BUTTON_SUFFIX = {"点击号码": "_clicks", "点击叉号": "_x"}
SEARCH_SUFFIX = "_searchs"
EXCLUSIVE_STOREY = "首页-专享"

CLICK_WEIGHT = {"terminal": 1, "broadband": 1, "package": 1, "number": 1, "family": 1}
SEARCH_WEIGHT = {"terminal": 1, "broadband": 1, "package": 1, "number": 1, "family": 1}
BIZ_WEIGHT = {"terminal": 1, "broadband": 1, "package": 1, "number": 1, "family": 1}

SECOND_MS = 1_000
DAY_MS = 86_400_000
DAY_OFFSET_MS = 8 * 3_600_000  # calendar days are UTC+8
QUEUE_LENGTH = 12
IDLE_GAP_MS = 7 * DAY_MS
PAD_BELOW = 5
LAST_BIZ_TTL_MS = 120 * SECOND_MS
SCORE_TTL_MS = 2 * DAY_MS
EXPOSURE_TTL_MS = 7 * DAY_MS
WATERMARK_DELAY = "3 seconds"

# End of the fixed values.

CLICK_CHANNEL = "click"
SEARCH_CHANNEL = "search"
CHANNELS = [CLICK_CHANNEL, SEARCH_CHANNEL]

_NUMBER_TYPES = [*NUMBER_TYPE_OF_CODE.values(), "null"]
# Columns of the wide table. Search labels carry the type as logged; these are the usual ones.
KNOWN_LABELS = (
    [t + s for s in BUTTON_SUFFIX.values() for t in _NUMBER_TYPES]
    + [t + SEARCH_SUFFIX for t in _NUMBER_TYPES]
    + ["user_last_biz", "biz_score", "biz_click", "biz_search", "expose_least_biz_7d", "expose_biz_his"]
)
