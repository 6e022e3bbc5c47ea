"""Fixed values of the line format, the limits and the messages.

These are the values other programs read and write; they are stated here once and
used by name everywhere else.
"""

# --- fixed values: envelope -------------------------------------------------
LINE_VERSION = "1.6.0"
ENVELOPE_PREFIX = "partnerapi_"
MARKER_KEY = ENVELOPE_PREFIX + "line"
PARTNER_REF_KEY = ENVELOPE_PREFIX + "partner_ref"
TIMESTAMP_KEY = ENVELOPE_PREFIX + "timestamp"
LEVEL_KEY = ENVELOPE_PREFIX + "level"
DIRECTION_KEY = ENVELOPE_PREFIX + "direction"
UPSTREAM_INTEGRATION_KEY = ENVELOPE_PREFIX + "upstream_integration"
UPSTREAM_BASE_URL_KEY = ENVELOPE_PREFIX + "upstream_base_url"
LINE_START = '{"' + MARKER_KEY + '":'
REFERENCE_SCHEME = "v1:"
LEVELS = ("debug", "info", "warn", "error")
DIRECTIONS = ("inbound", "outbound")

# --- fixed values: line fields, context field -> line field, in line order ---
CONTEXT_FIELDS = (
    ("request_id", "request_id"),
    ("path", "path"),
    ("method", "method"),
    ("status_code", "status_code"),
    ("duration", "duration_ms"),
    ("correlation_id", "correlation_id"),
)
REQUEST_MESSAGE = "Incoming request"
RESPONSE_MESSAGE = "Outgoing response"
SENSITIVE_HEADERS = (
    "authorization",
    "cookie",
    "set-cookie",
    "x-api-key",
    "x-tenant-token",
    "proxy-authorization",
)
REDACTED = "[REDACTED]"

# --- fixed values: upstream calls --------------------------------------------
REQUEST_ID_HEADERS = (
    "request-id",
    "x-request-id",
    "x-amzn-requestid",
    "x-amz-request-id",
    "x-ms-request-id",
    "x-github-request-id",
    "cf-ray",
)
CURL_ERROR_NAMES = {
    5: "CURLE_COULDNT_RESOLVE_PROXY",
    6: "CURLE_COULDNT_RESOLVE_HOST",
    7: "CURLE_COULDNT_CONNECT",
    28: "CURLE_OPERATION_TIMEDOUT",
    35: "CURLE_SSL_CONNECT_ERROR",
    47: "CURLE_TOO_MANY_REDIRECTS",
    52: "CURLE_GOT_NOTHING",
    55: "CURLE_SEND_ERROR",
    56: "CURLE_RECV_ERROR",
    60: "CURLE_PEER_FAILED_VERIFICATION",
}
CALL_LIMITS = {
    "name": 128,
    "method": 16,
    "url": 2048,
    "requestId": 128,
    "errorCode": 128,
    "message": 1024,
}
MAX_ATTEMPT = 1000
TRAIL_MAX_CALLS = 20
TRAIL_MAX_BYTES = 8192

# --- fixed values: limits ------------------------------------------------------
MAX_LINE_BYTES = 1 << 20
MAX_PARTS = 64
STORED_LINE_BYTES = 250_000
MAX_ATTRIBUTION_BYTES = 1024
MAX_AGE_SECONDS = 7 * 24 * 3600
MAX_AHEAD_SECONDS = 9 * 60
PUSH_BATCH = (1000, 1_000_000)
EXPORT_BATCH = (100, 4 << 20)
REPORT_INTERVAL_MS = 60_000
METRIC_MAX_POINTS = 1000
METRIC_MAX_SERIES_BYTES = 50

# --- fixed values: rejection reasons of a stored line, in order of test ---------
LINE_REASONS = (
    "no_marker",
    "unparseable_line",
    "unsupported_marker",
    "missing_partner_ref",
    "bad_level",
    "bad_timestamp",
    "timestamp_out_of_range",
    "bad_direction",
    "bad_upstream_attribution",
)
UNMATCHED = "unmatched"
UNMATCHED_TEXT = "unmatched (partner reference resolves to no approved app)"
