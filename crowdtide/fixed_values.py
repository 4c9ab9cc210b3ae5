"""Values that have to be equal everywhere for results to agree."""

from __future__ import annotations

# The polarity lexicon.
POSITIVE_WORDS = [
    "buy", "long", "bull", "bullish", "rally", "up", "profit", "target", "breakout", "support",
]
NEGATIVE_WORDS = [
    "sell", "short", "bear", "bearish", "down", "loss", "stoploss", "crash", "resistance",
]

# The keywords posts are collected for, in visiting order.
KEYWORDS = [
    "#nifty50", "#sensex", "#intraday", "#banknifty", "#stockmarkets", "#stocks", "#trading",
    "#candlestick", "#market", "#ipo", "#investing", "#equities", "#stockmarketindia",
]

# Post columns, in file order.
POST_COLUMNS = [
    "id", "username", "date", "content", "replyCount", "retweetCount", "likeCount", "quoteCount",
    "mentions", "hashtags", "url", "source_hashtag",
]
COUNT_COLUMNS = ["replyCount", "retweetCount", "likeCount", "quoteCount"]

# Engagement kinds, in the order a label is tested for them, and the
# plural that the text pass looks for.
LABEL_KINDS = ["like", "retweet", "reply", "quote"]
TEXT_KINDS = {"like": "likes", "retweet": "retweets", "reply": "replies", "quote": "quotes"}
COUNT_OF_KIND = {
    "like": "likeCount", "retweet": "retweetCount", "reply": "replyCount", "quote": "quoteCount",
}

# Patterns.
HANDLE = "[A-Za-z0-9_]{1,15}"
LABEL_NUMBER = r"[\d,\.]+"
LABEL_WORD = "[A-Za-z]+"
RESERVED_HANDLES = ["status", "search", "i"]
HANDLE_LINES = 6
PERMALINK_MARK = "/status/"
PERMALINK_BASE = "https://x.com"
BODY_MARK = "tweetText"

# Job defaults.
HASH_WIDTH = 2**18
CHUNK_ROWS = 500
BATCH_ROWS = 200
EMBED_BATCH = 64
WINDOW = "5min"
MIN_POSTS = 3
WEIGHT_EMBEDDING = 0.7
WEIGHT_LEXICAL = 0.3
THRESHOLD = 0.6
CONFIDENCE = 0.95
ROWS_PER_VISIT = 50
PLOT_POINTS = 1200
PLOT_OFFSET_FLOOR = 0.001
PLOT_OFFSET_SHARE = 0.05
UNKNOWN_DAY = "unknown"
INPUT_FILES = "{batch_,idle_batch_}*.jsonl"

# The characters Python counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
