"""Status words of loads and runs, as they are logged, and outcomes of whole projects."""

# Fixed values.
START = "START"
DONE = "DONE"
WARN = "WARN"
ERROR = "ERROR"
END = "END"

WITHOUT_FAULT = "Completed successfully"
WITH_WARNINGS = "Completed with warnings"
WITH_ERRORS = "Completed with errors"
