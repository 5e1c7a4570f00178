"""Word lists, patterns and constants that results depend on.

They are inputs to the computation, not logic; every operator takes them as
default arguments so a caller can bring their own.
"""

# --- fixed values: words that carry no meaning in titles -------------------
TITLE_STOPWORDS = [
    "the", "a", "an", "of", "in", "on", "to", "for", "and", "or",
    "at", "by", "is", "it", "as", "be", "was", "are", "its", "with",
    "that", "this", "from", "before", "after", "hearing", "committee",
    "subcommittee", "full", "oversight", "examine", "examining",
    "regarding", "concerning", "review", "united", "states", "senate",
    "house", "congress", "testifies", "testimony", "witnesses",
    "hearings", "focusing",
]

# --- fixed values: title decoration, removed in this order -----------------
TITLE_STRIP_PATTERNS = [
    r"(?i)^HEARING NOTICE:?\s*",
    r"(?i)^Hearing\s+Entitled:?\s*",
    r"(?i)^Oversight\s+Hearing\s*[-:]\s*",
    r"(?i)^Hearings?\s*:?\s*",
    r"(?i)^(Full Committee |Subcommittee )?Hearing:?\s*",
    r"(?i)^[\p{L}\p{N}_&]+\s+Hearing:?\s*",
    r"^\d{1,2}/\d{1,2}/\d{2,4}\s*",
    r"^\*+[A-Z\s]+\*+\s*",
    r"(?i)^Upcoming\s*:?\s*",
    r"(?i)^(An? )?(Oversight )?Hearing[s]?\s+to\s+(examine|consider)\s+",
    r"(?i)\s+(Location|Time):.*$",
    r"(?i)WASHINGTON,?\s*D\.?C\.?\s*[-–—].*$",
]

# --- fixed values: month names ---------------------------------------------
MONTHS = {
    "january": 1, "jan": 1, "february": 2, "feb": 2, "march": 3, "mar": 3,
    "april": 4, "apr": 4, "may": 5, "june": 6, "jun": 6, "july": 7, "jul": 7,
    "august": 8, "aug": 8, "september": 9, "sep": 9, "sept": 9,
    "october": 10, "oct": 10, "november": 11, "nov": 11, "december": 12, "dec": 12,
}

# --- fixed values: phrases of procedural sessions --------------------------
PROCEDURAL_PHRASES = [
    "markup of", "full committee markup", "subcommittee markup", "mark up of",
    "to consider the following", "business meeting", "organizational meeting",
    "member day", "meeting announcement",
]

# --- fixed values: phrases that mark a clip rather than a full record ------
CLIP_PHRASES = [
    "opening statement", "opening remarks", "delivers opening statement",
    "reaction to", "response to", "comments on",
    "joins squawk", "joins fox", "joins cnn", "joins msnbc", "joins cnbc",
    "appears on", "interview", "press conference", "news conference",
    "floor speech", "floor remarks", "floor consideration",
    "talks ", "on the claman countdown", "exposes the",
]

# --- fixed values: title prefixes of unrelated programming -----------------
PROGRAM_PREFIXES = [
    "washington today", "after words:", "lectures in history:",
    "booknotes", "q&a podcast:", "abc podcast:", "america's book club",
    "ceasefire podcast:", "extreme mortman:",
]

# --- fixed values: abbreviations kept in capitals --------------------------
ABBREVIATIONS = [
    "U.S.", "USA", "GDP", "CBO", "OMB", "GAO", "FBI", "CIA", "NSA",
    "DOD", "DOJ", "EPA", "IRS", "SEC", "FDIC", "FED", "FOMC",
    "NATO", "UN", "EU", "IMF", "WHO", "COVID", "AI", "DOGE",
    "HHS", "HUD", "DHS", "FEMA", "SBA", "NIH", "CDC", "FDA",
    "CFPB", "FHFA", "FSOC", "OCC", "CFTC", "NCUA",
]

# --- fixed values: link vocabulary -----------------------------------------
TESTIMONY_PATTERN = (
    r"(?i)testimony|statement|written|prepared|download|witness|"
    r"submitted|oral|opening\s+remarks|full\s+text"
)
LINK_EXCLUDE_PATTERN = (
    r"(?i)livestream|webcast|video|archive|press\s+release|"
    r"add\s+to\s+calendar|rss|share|print|twitter|facebook|"
    r"instagram|youtube|podcast"
)
HOUSE_DOC_PATH_PATTERN = r"(?i)/sites/default/files/|/uploads/|/documents/|/files/"
WP_UPLOAD_PATTERN = r"(?i)/wp-content/uploads/\d{4}/\d{2}/[^/]+\.pdf"
FILE_EXT_PATTERN = r"\.[\p{L}\p{N}_]{2,4}$"
EMBED_ID_PATTERN = r"(?i)youtube\.com/embed/([A-Za-z0-9_-]{11})"
PROGRAM_ID_PATTERN = r"/(?:program|event)/[^/]+/[^/]+/(\d+)"
PLAYER_IFRAME_PATTERN = r"""(?i)<iframe[^>]+src=["']([^"']*senate\.gov/isvp/[^"']*)["']"""

NAV_WORDS = ["next", "previous", "page", "more"]
GENERIC_NAV_WORDS = [
    "next", "previous", "page", "more", "login", "sign in",
    "contact", "about", "home", "search",
]

# --- fixed values: caption time line ---------------------------------------
CUE_TIME_PATTERN = r"^(\d{2}:\d{2}:\d{2}\.\d{3})\s*-->\s*(\d{2}:\d{2}:\d{2}\.\d{3})"

# --- fixed values: artefact kinds, best first ------------------------------
ARTIFACT_PRIORITY = [
    "govinfo_transcript", "cspan_cleaned", "cspan_transcript", "isvp_cleaned",
    "isvp_transcript", "cleaned_transcript", "captions",
]

# --- fixed values: processing stages in order ------------------------------
STAGES = ["captions", "isvp", "cspan", "testimony", "govinfo", "publish"]

# --- fixed values: USD per million tokens (input, output) ------------------
MODEL_PRICES = [
    ("google/gemini-2.0-flash-001", 0.10, 0.40),
    ("google/gemini-2.0-flash-lite-001", 0.075, 0.30),
    ("openai/gpt-4o-mini", 0.15, 0.60),
    ("google/gemini-3-flash-preview", 0.50, 3.00),
    ("anthropic/claude-haiku-4-5", 1.00, 5.00),
]

# --- fixed values: thresholds ----------------------------------------------
SAME_DAY_SIMILARITY = 0.30
ADJACENT_DAY_SIMILARITY = 0.45
CROSS_KEY_SIMILARITY = 0.4
CLIP_SIMILARITY = 0.15
STREAM_SIMILARITY = 0.10
SCORE_THRESHOLD = 0.40
MAX_QUOTES = 30
GAP_SECONDS = 8.0
CHUNK_TOKENS = 3000
OVERLAP_TOKENS = 200
MIN_RECORD_SECONDS = 600
MIN_STREAM_SECONDS = 1800
MAX_ATTEMPTS = 5
MAX_BACKOFF_SECONDS = 3600

# Statuses whose attempts count as retries, by queue.
OPEN_STATUSES = {"stage_tasks": ("pending", "running", "failed"), "outbox": ("pending", "processing", "dead_letter")}

# --- fixed value: page of a video, before its id ----------------------------
VIDEO_PAGE = "https://www.youtube.com/watch?v="
