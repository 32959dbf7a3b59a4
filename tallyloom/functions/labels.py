"""Labels that appear in the data and in the reports."""

# The reports are only right if these texts are exactly these.
STATUS_INACTIVE = "Inactive"
STATUS_ACTIVATED = "Activated by LGLC"
STATUS_ALREADY_ACTIVE = "Already Active"
FAVOURITE_STATUSES = ["Activated by LGLC", "Already Active"]
CATEGORY_FAVOURITE = "Favourite"
CATEGORY_INACTIVE = "Inactive"
STAGE_SALE_DONE = "Sale-Done"
DISPOSITION_REMAP = "Remap-DP"
VERTICAL_HEALTH = "HEALTH"
BUSINESS_TYPES = ["NEW", "PORTABILITY"]
ERROR_MARKERS = ["#N/A", "#REF!"]
UNMAPPED = "Unmapped"
TEAM_UNKNOWN = "unknown"
RUN_MODES = ["MANUAL", "CATCH-UP", "REGULAR"]

# Fixed values of the name matcher: a match needs a score above the threshold,
# and an equal first letter adds the bonus.
MATCH_THRESHOLD = 55
FIRST_LETTER_BONUS = 5

# Default cut-offs of the partner status.
ALREADY_ACTIVE_BEFORE = "2024-08-01"
POLICIES_SINCE = "2024-01-01"
