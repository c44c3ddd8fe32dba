"""Fixed values that must equal the source pipeline's for identical results.

Everything in this module is data, stated plainly and in its natural order.
Nothing here is logic; the Spark expressions that use these values live in
the sibling modules.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must not change: they define which log lines parse and how)
# ---------------------------------------------------------------------------

# Access-line pattern of the hourly ingest, in its effective (Python ``re``)
# form: named groups, ``\s``/``\d``/``\w`` with Python's Unicode meaning, a
# forwarded IP list allowed in ``ip``, and the line must contain its newline.
ACCESS_PATTERN_HOURLY = (
    r"\[pid:\s(?P<pid>\d*)\|app:\s-\|req:\s-\/-]\s"
    r"(?P<ip>(?:\d+\.\d+\.\d+\.\d+(?:,\s)?)+)\s\(-\)\s"
    r"\{(?P<num_request_variables>\d*)\svars\sin\s(?P<packet_size>\d*)\sbytes}\s"
    r"\[(?P<time_received>.*)]\s(?P<http_method>\w*)\s(?P<uri>\/.*)\s"
    r"=(?:\u003e|>)\sgenerated\s(?P<response_size>\d*)\sbytes\sin\s"
    r"(?P<response_time>\d*)\smsecs\s\(HTTP\/(?:\d*\.\d*)\s(?P<http_status>\d*)\)\s"
    r"(?P<num_headers>\d*) headers\sin\s(?P<header_size>\d*)\sbytes\s"
    r"\((?P<switches>\d*)\sswitches\son\score\s(?P<core>\d*)\)\s"
    r"referrer:\s(?P<referrer>[^\s]*)\sUA\s(?P<user_agent>.*)\s"
    r"has\swallet:\s(?P<has_wallet>.*)\scookies:\s(?P<cookies>.*)\n"
)

# Access-line pattern of the one-off daily backfill: a single IP of ``\d*``
# octets followed by a literal space, everything else identical.
ACCESS_PATTERN_BACKFILL = (
    r"\[pid:\s(?P<pid>\d*)\|app:\s-\|req:\s-\/-] "
    r"(?P<ip>\d*\.\d*\.\d*\.\d*) \(-\)\s"
    r"\{(?P<num_request_variables>\d*)\svars\sin\s(?P<packet_size>\d*)\sbytes}\s"
    r"\[(?P<time_received>.*)]\s(?P<http_method>\w*)\s(?P<uri>\/.*)\s"
    r"=(?:\u003e|>)\sgenerated\s(?P<response_size>\d*)\sbytes\sin\s"
    r"(?P<response_time>\d*)\smsecs\s\(HTTP\/(?:\d*\.\d*)\s(?P<http_status>\d*)\)\s"
    r"(?P<num_headers>\d*) headers\sin\s(?P<header_size>\d*)\sbytes\s"
    r"\((?P<switches>\d*)\sswitches\son\score\s(?P<core>\d*)\)\s"
    r"referrer:\s(?P<referrer>[^\s]*)\sUA\s(?P<user_agent>.*)\s"
    r"has\swallet:\s(?P<has_wallet>.*)\scookies:\s(?P<cookies>.*)\n"
)

# Framework "404" lines that carry no access record.
NOT_FOUND_PREFIXES = ("WARNING:django.request:Not Found:", "Not Found:")

# Captures converted with int(); an empty capture makes the line bad.
INT_FIELDS = (
    "pid", "num_request_variables", "packet_size", "response_size", "response_time",
    "http_status", "num_headers", "header_size", "switches", "core",
)

# Cookie keys copied to columns, as (cookie key, column name).
COOKIE_COLUMNS = (
    ("session_id", "session_id"),
    ("user_id", "user_id"),
    ("uuid", "user_id_uuid"),
    ("_ga", "ga_ga"),
    ("_gid", "ga_gid"),
)

# has_wallet is true only for this exact (case-sensitive) capture.
WALLET_TRUE = "true"

# Longest HTTP method kept (the column is varchar(10)).
MAX_HTTP_METHOD_LEN = 10

# Page-log filters.
NOTIFICATION_URI_PATTERN = "^/notification/"
PING_URI = "/analytics/ping/"
BOUNTY_REFERRER_PATTERN = "/bounty/[0-9]+"
BOUNTY_ID_PATTERN = "/bounty/([0-9]+)"

# Stored columns of the raw log table, in table order (row_added excluded).
RAW_COLUMNS = (
    "pid", "ip", "num_request_variables", "packet_size", "time_received",
    "http_method", "uri", "response_size", "http_status", "num_headers",
    "header_size", "switches", "core", "referrer", "user_agent", "has_wallet",
    "session_id", "user_id", "user_id_uuid", "ga_ga", "ga_gid",
)

# Columns of the page log, in table order (row_added excluded).
PAGE_LOG_COLUMNS = (
    "time_received", "uri", "referrer", "user_agent", "has_wallet", "ip",
    "session_id", "user_id", "user_id_uuid", "ga_ga", "ga_gid",
)

# Columns of the bounty view log, in table order.
VIEW_LOG_COLUMNS = (
    "time_received", "bounty_id", "user_agent", "has_wallet", "ip",
    "session_id", "user_id", "user_id_uuid", "ga_ga", "ga_gid",
)

# Columns of the bounty snapshot, in table order.
SNAPSHOT_COLUMNS = (
    "bounty_id", "title", "description", "bounty_stage", "usd_price",
    "user_id", "deadline", "created", "ymd",
)

# "Never visited before": the source uses the date -infinity; Spark has no
# such date, so the smallest proleptic date stands in for it.
NEVER_VISITED = "0001-01-01"

# Outcome labels of a parsed line.
GOOD = "good"
BAD = "bad"
REGEX_FAILED = "regex_failed"
SKIPPED = "skipped"
REJECTED = "rejected"
# Not an outcome of a line: the native pass leaves it to the literal parser.
UNDECIDED = "undecided"

# Parse modes: hourly ingest and the one-off daily backfill.
HOURLY = "hourly"
BACKFILL = "backfill"
