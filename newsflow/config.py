"""Knobs of the article pipeline, exposed as plain parameters.

Fixed values: these must equal the behaviour being reproduced.
"""

# --- fixed values -----------------------------------------------------------
SUMMARY_WORDS = 175                 # summary length, min = max
BATCH_CONTENT_CHARS = 1500          # content cap per article inside a batch prompt
SINGLE_CONTENT_CHARS = 3000         # content cap inside a single-article prompt
EMBED_TEXT_CHARS = 8000             # cap of the text handed to the embedder
MAX_PER_FEED = 50                   # entries taken from one feed per run
MAX_RESULTS = 10                    # default number of search results
SIMILARITY_THRESHOLD = 0.25         # keep matches with score >= this
EMBED_DIM = 1024                    # width of the default hashed embedding
SUMMARY_BATCH = 20                  # articles per summary call
TRENDING_SAMPLE = 50                # matches analysed by trending topics
TRENDING_QUERY = "news today current events"
PREVIEW_ROWS = 50                   # rows shown by the latest-snapshot preview
KEEP_RUNS = 10                      # newest raw / processed runs kept
ARCHIVE_AFTER_DAYS = 30
TITLE_CAP = 1000                    # vector metadata caps
SUMMARY_CAP = 2000
TAGS_CAP = 10
PREVIEW_CHARS = 500
SUMMARY_SEPARATOR = "---SUMMARY_SEPARATOR---"
DEFAULT_CATEGORY = "general"
NO_SUMMARY_TEXT = "No summary available."
UNKNOWN_DATE_TEXT = "Unknown date"
INVALID_DATE_TEXT = "Invalid Date"
UNKNOWN_SOURCE_TEXT = "Unknown Source"
INDEX_NAME = "news-articles"
NAMESPACE = "default"

# A fixed run timestamp used by the registered queries so reruns compare equal.
DEFAULT_RUN_TS = "2024-06-01T00:00:00"
