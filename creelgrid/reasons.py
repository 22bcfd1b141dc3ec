"""Why a row is not used."""

# Reason texts as published, in the order the screens run.
LOCATION_NOT_BOAT = "Location not MODE_FX == 7 (PR data)"
LOCATION_EMPTY = "Location data does not include any block or coordinate data."
LOCATION_RANGE = "HGSize or HGSize2 reported "
LOCATION_BAD_COORDS = "Bad COORDS REPORTED"
LOCATION_OFF_MAP = "No fishing block overlapped with coordinate."
LOCATION_CONFLICT = "Duplicate IDs used for both Pr1 and Pr2"
CATCH_BAD_CODE = "SP_CODE is not valid."
CATCH_NO_SPECIES = "Species not found in Lookup."
CATCH_AMBIGUOUS = "Duplicate IDs caused by data entry"
NO_LOCATION = "Does not have corresponding location data by ID"
EFFORT_UNPLACED = "Angler form data that is could not be flagged as leader or follower"
EFFORT_NO_SPECIES = "Primary Species not found in species lookup."
EFFORT_NO_CONTRIBUTORS = "Zero contributors reported in data"
CATCH_NO_EFFORT = "Catch was reported with no corresponding effort"
BLOCK_OFF_MAP = "Block is not in reference shapefile"

# Reasons of our own, for rows that would otherwise vanish without a trace.
MISSING_ID = "Trip id is missing"
LOCATION_REPLACED = "Old row of the year that the newer files replace"
LOCATION_NO_YEAR = "Old row without a year"
LOCATION_UNUSABLE_COORDS = "Coordinate is on the limit or not a number"
EFFORT_FOLLOWER_ALONE = "Follower without a leader row"
EFFORT_BAD_CONTRIBUTORS = "Contributors are not a positive number"
EFFORT_AMBIGUOUS = "Several effort rows for one trip, trip type and year"

LOCATION = [
    LOCATION_REPLACED, LOCATION_NO_YEAR, MISSING_ID, LOCATION_NOT_BOAT, LOCATION_EMPTY, LOCATION_RANGE, LOCATION_BAD_COORDS,
    LOCATION_UNUSABLE_COORDS, LOCATION_OFF_MAP, LOCATION_CONFLICT,
]
OBSERVED = [MISSING_ID, CATCH_BAD_CODE, CATCH_NO_SPECIES, NO_LOCATION]
REPORTED = [MISSING_ID, CATCH_BAD_CODE, CATCH_NO_SPECIES, NO_LOCATION, CATCH_AMBIGUOUS]
EFFORT = [
    EFFORT_UNPLACED, EFFORT_FOLLOWER_ALONE, EFFORT_NO_SPECIES, NO_LOCATION,
    EFFORT_NO_CONTRIBUTORS, EFFORT_BAD_CONTRIBUTORS, EFFORT_AMBIGUOUS,
]
OUTPUT = [CATCH_NO_EFFORT]
