"""Fixed values.

These must equal the values of the application this library replaces, so
that payments, queues and reports come out the same. They are stated here
together; the modules import them.
"""

from datetime import datetime

# Pay: base per month with a counted report, cap on counted reports per
# worker-month, bonus per counted report by treatment arm.
BASE_PAY = 10000
REPORT_CAP = 30
WORKER_BONUS = {2: 2000, 3: 1000}
SUPERVISOR_BONUS = {1: 2000, 3: 1000}

# Service dates: format day.month.4-digit-year; accepted up to 8 weeks before the report.
MAX_SERVICE_AGE_DAYS = 56
# Roster training dates: day.month.2-digit-year, years from 69 read as 19xx.
TWO_DIGIT_YEAR_PIVOT = 69

# Message id: a missing field is spelled like this inside the hashed text.
MISSING_FIELD_TEXT = "None"

# Status events and the time given to flag-derived called / noConsent events.
EVENT_NAMES = ("called", "attempted", "noConsent")
FLAG_EVENT_TIME = datetime(1970, 1, 1)

# Calls: share of recent reports to verify, look-back window, and the
# placeholders used for training reports and tester numbers.
DEFAULT_TARGET = 0.2
DEFAULT_SINCE_DAYS = 28
TEST_DISTRICT = "Test"
TESTER_NAME = "Tester McTesterson"
NO_TRAINING_DATE = datetime(1970, 1, 1)

# Survey: id of the "did the patient receive care" question, the suffixes
# of report and survey columns with the same name in merged output, and the
# hidden fields dropped from the reconciled report.
PROVIDED_CARE_QUESTION = "tN8EHB01kUah"
MERGE_SUFFIXES = ("_app", "_typeform")
REPORT_HIDDEN_FIELDS = ("_id", "messageid", "patient", "patientphone", "worker", "workerphone")
