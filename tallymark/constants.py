"""Words, patterns and limits the results depend on.

Nothing here is logic. Every list is in the order in which it is tried.
"""

# --- tables -----------------------------------------------------------------
METRICS = ["impressions", "clicks", "likes", "comments", "shares", "reach"]
POST_KEY = ["post_id"]
HISTORY_KEY = ["company_id", "post_id", "observed_date"]
FOLLOWER_KEY = ["company_id", "demographic_type", "demographic_value", "date_collected"]
COMPANY_KEY = ["company_id"]
BULKY_COLUMNS = ["post_content", "post_url", "post_title", "hashtags", "mentions"]

# --- limits -----------------------------------------------------------------
CONTENT_LENGTH = 2000
TITLE_LENGTH = 500
DEMOGRAPHIC_VALUE_LENGTH = 255
REPORT_TEXT_LENGTH = 100
MAX_TAGS = 50
MAX_PERCENT = 100.0
HEADER_SEARCH_ROWS = 10
RETENTION_DAYS = 90

# --- column candidates, current profile ----------------------------------------
POST_COLUMNS = {
    "title": ["post title", "title"],
    "link": ["post link", "url", "link", "permalink"],
    "distribution": ["post type"],
    "content_type": ["content type", "content format", "format", "media", "type"],
    "created": ["created date", "date", "published"],
    "impressions": ["impressions"],
    "views": ["views", "offsite views"],
    "clicks": ["clicks", "link clicks", "unique clicks"],
    "ctr": ["click through rate (ctr)", "ctr"],
    "likes": ["likes", "reactions"],
    "comments": ["comments"],
    "shares": ["reposts", "shares", "share"],
    "engagement_rate": ["engagement rate", "engagement"],
    "campaign_start": ["campaign start date"],
}

# --- column candidates, older ("manual") profile ---------------------------------
MANUAL_POST_COLUMNS = {
    "title": ["post", "content", "message", "text", "description", "update"],
    "created": ["date", "created", "published", "time", "posted"],
    "impressions": ["impressions", "views", "reach", "seen"],
    "clicks": ["clicks", "click", "ctr"],
    "likes": ["likes", "reactions", "love", "thumbs"],
    "comments": ["comments", "comment"],
    "shares": ["shares", "share", "reposts", "repost"],
    "engagement_rate": ["engagement", "rate", "er"],
    "content_type": ["type", "format", "media", "kind"],
    "link": ["url", "link", "permalink", "href"],
}

# --- demographic sheets ------------------------------------------------------------
DEMOGRAPHIC_VALUE_WORDS = ["name", "value", "location", "function", "title", "category"]
DEMOGRAPHIC_COUNT_WORDS = ["count", "number", "followers", "audience", "members", "total"]
DEMOGRAPHIC_PERCENT_WORDS = ["percentage", "percent", "%", "share", "pct"]
DEMOGRAPHIC_TYPES = [
    ("location", ["location", "country", "city", "region", "geography"]),
    ("job_function", ["function", "job", "role", "occupation"]),
    ("seniority", ["seniority", "level", "experience"]),
    ("company_size", ["company", "organization", "employer", "size"]),
]
MANUAL_DEMOGRAPHIC_TYPES = [
    ("location", ["location", "country", "city", "region", "geography"]),
    ("job_function", ["function", "industry", "job", "role", "occupation"]),
    ("seniority", ["seniority", "level", "experience", "senior", "junior"]),
    ("company_size", ["company", "organization", "employer", "size"]),
]

# --- header rows -------------------------------------------------------------------
HEADER_HINTS = [
    "post", "title", "link", "impressions", "views", "click", "ctr", "likes", "comments",
    "repost", "share", "engagement", "content type", "created", "date", "published",
]
HEADER_INDICATORS = [
    "date", "impressions", "clicks", "shares", "likes", "comments", "engagement", "reach",
    "post", "content", "message", "update", "location", "function", "seniority", "industry",
    "company", "followers", "sponsored", "organic",
]

# --- post types --------------------------------------------------------------------
POST_TYPES = ["text", "article", "image", "document", "video"]
DISTRIBUTION_WORDS = ["organic", "sponsored", "paid", "boosted", "promoted"]
RECLASSIFIED_TYPES = ["organic", "sponsored", "paid", "boosted", ""]
IMAGE_TYPE_WORDS = ["image", "photo", "picture"]
IMAGE_TEXT_WORDS = ["image", "photo", "picture", "jpg", "jpeg", "png"]
DOCUMENT_TYPE_WORDS = ["document", "pdf", "doc"]
DOCUMENT_TEXT_WORDS = ["document", "pdf", ".ppt", ".pptx", ".doc", ".docx", ".slideshare"]
ARTICLE_TYPE_WORDS = ["article", "link"]
ARTICLE_TEXT_WORD = "/pulse/"
TEXT_TYPE_WORDS = ["text", "status"]

# --- files and messages ----------------------------------------------------------------
EXPORT_EXTENSIONS = [".csv", ".xls", ".xlsx", ".zip"]
MANUAL_EXTENSIONS = [".csv", ".xls", ".xlsx"]
PARTIAL_DOWNLOAD_SUFFIXES = [".crdownload", ".part", ".tmp"]
POSTS_FILE_WORDS = ["post", "content", "update", "overview"]
MANUAL_POSTS_FILE_WORDS = ["company", "overview", "content", "post"]
DEMOGRAPHICS_FILE_WORDS = ["demographic", "audience", "follower"]
POSTS_SHEET_WORDS = ["post"]
MANUAL_POSTS_SHEET_WORDS = ["post", "content", "update", "organic", "sponsored"]
DOWNLOAD_WORDS = [
    "linkedin", "page", "analytics", "export", "content", "updates", "posts", "followers",
    "demographics",
]
SENDER_WORD = "linkedin"
EXPORT_SUBJECT_WORDS = [
    "export", "analytics", "page analytics", "content", "posts", "demographics", "follower",
    "audience",
]
DIGEST_SUBJECT_WORDS = ["page update", "page analytics", "weekly update", "your page"]
ENCODINGS = ["utf-8", "cp1252", "latin-1"]
MANUAL_ENCODINGS = ["utf-8", "latin-1"]

# Cell texts that stand for "missing" in spreadsheets (the pandas reader's documented default).
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- patterns ---------------------------------------------------------------------------
URN_PATTERN = r"(urn:li:(?:activity|ugcPost):[0-9]+)"
HASHTAG_PATTERN = r"(?<!&)#([\p{L}\p{N}_]+)"
MENTION_PATTERN = r"@([\p{L}\p{N}_.\-]+)"
AMBIGUOUS_DATE_PATTERN = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})"
DIGEST_FOLLOWER_PATTERNS = [
    r"(?i)([\d,.]+)\s+followers",
    r"(?i)total followers[:\s]+([\d,.]+)",
    r"(?i)followers[:\s]+([\d,.]+)",
]
DIGEST_IMPRESSION_PATTERNS = [
    r"(?i)([\d,.]+)\s+impressions",
    r"(?i)update impressions[:\s]+([\d,.]+)",
]
PLAUSIBLE_FIRST_YEAR = 2015
