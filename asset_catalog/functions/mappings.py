"""Function names of the source dialect and what takes their place."""

# The shipped mapping of function names. `date` drops the time of day.
FUNCTIONS = {"strpos": "instr", "from_iso8601_timestamp": "date"}

# The same with the time of day kept; it is not the shipped default.
FUNCTIONS_KEEPING_TIME = {"strpos": "instr", "from_iso8601_timestamp": "to_timestamp"}
