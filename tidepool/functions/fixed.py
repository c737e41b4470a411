"""Fixed values that results depend on.

FIXED VALUES -- these must stay exactly as written for results to match the
reference jobs' semantics.  They are plain data, listed together, in natural
order.
"""

# Word tokenizer: lower-case the line, split on runs of non-word characters
# (ASCII word class [A-Za-z0-9_], as in a Java regex without Unicode flags),
# drop empty pieces.
WORD_SPLIT_PATTERN = r"\W+"

# Tweet tokenizer: the default delimiter set of a whitespace string tokenizer
# (space, tab, newline, carriage return, form feed) ...
TWEET_DELIMITER_PATTERN = "[ \t\n\r\f]+"
# ... then every remaining whitespace character of the Java \s class is
# removed from each token (this adds the vertical tab, \x0B).
TWEET_STRIP_PATTERN = "[ \t\n\x0B\f\r]"

# JSON paths read from each tweet-like record.
JSON_TEXT_PATH = "$.text"
JSON_LANG_PATH = "$.user.lang"
ENGLISH = "en"

# Telemetry line layout: "(car_id,speed,distance,epoch_ms)".
TELEMETRY_FIELDS = ("car_id", "speed", "distance", "ts_ms")

# Default job parameters of the eight reference jobs.
COUNT_WINDOW_SIZE, COUNT_WINDOW_SLIDE = 10, 5           # word count job
WINDOW_WORDS_SIZE, WINDOW_WORDS_SLIDE = 6, 1            # windowed word count job
SLIDING_SIZE_MS, SLIDING_SLIDE_MS = 2500, 500           # grouped processing-time job
KEYED_RANGE_ELEMENTS, KEYED_RANGE_KEYS = 20_000_000, 10_000
SESSION_GAP_MS = 3                                      # session job
SESSION_WATERMARK_LAG_MS = 16                           # session job source
TOP_SPEED_TRIGGER_METERS = 50.0                         # top speed job
TOP_SPEED_EVICTION_SEC = 10
KMH_TO_MPS_DIVISOR = 3.6                                # metres per second = km/h / 3.6
