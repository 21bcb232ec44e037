"""Table schemas (as DDL text), status domains and the fixed values of the job."""

# Host, templates, sentinel, labels, limits and zones results depend on.
SITE_HOST = "https://finance.yahoo.com"
SITE_TOKEN = "finance.yahoo.com"
LISTING_TEMPLATE = "https://finance.yahoo.com/quote/%1$s/news?p=%1$s"
NEWS_TOKEN = "/news/"
RAW_KEY_TEMPLATE = "raw/%s/%s/news.csv"
RESULT_KEY_TEMPLATE = "results/%s/%s.csv"
NO_CONTENT = "본문 없음"
UNKNOWN_LABEL = "unknown"
LOCAL_ZONE = "Asia/Seoul"
CHUNK_CHARS = 1100
SENTIMENT_CHARS = 512
KEYWORDS_TOP_K = 5
KEYWORD_SEPARATOR = ", "
LISTED_ERROR = "not fetched"
SECOND_FETCH = "browser"
STOP_TOP_N = 15
STOP_LOOKBACK_DAYS = 7
MAX_ARTICLES_PER_TICKER = 200
MIN_LEN_FOR_OK = 120
LATEST_RUNS = 100
LIST_FILES_MAX = 1000
FILE_KEY_CHARS = 255
DAG_STATUSES = ("pending", "running", "success", "failed", "partial")

RESULT_COLUMNS = ("summary", "sentiment", "keywords")
PARTITION_KEYS = ("ticker", "date")
# The order in which rows of a day were landed; positions restart with every listing.
LANDING_ORDER = ("fetched_at", "run_id", "pos", "url")

RAW_PAGES = (
    "url STRING, html STRING, status_code INT, fetch_kind STRING, fetched_at TIMESTAMP"
)
RAW_NEWS = (
    "url STRING, title STRING, content STRING, status_code INT, fetched_at STRING, "
    "run_id STRING, error STRING, pos BIGINT, ticker STRING, date DATE"
)
RESULTS = (
    "url STRING, fetched_at STRING, run_id STRING, pos BIGINT, summary STRING, "
    "sentiment STRING, keywords STRING, ticker STRING, date DATE"
)
CRAWLING_HISTORY = (
    "id BIGINT, run_id STRING, ticker STRING, crawl_date DATE, article_count INT, "
    "s3_raw_path STRING, status STRING, error_message STRING, started_at TIMESTAMP, "
    "completed_at TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP"
)
ANALYSIS_HISTORY = (
    "id BIGINT, run_id STRING, ticker STRING, analysis_date DATE, "
    "crawling_history_id BIGINT, s3_result_path STRING, sentiment_avg DECIMAL(5,4), "
    "sentiment_positive_ratio DECIMAL(5,4), sentiment_negative_ratio DECIMAL(5,4), "
    "sentiment_neutral_ratio DECIMAL(5,4), keyword_count INT, status STRING, "
    "error_message STRING, started_at TIMESTAMP, completed_at TIMESTAMP, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)
DAG_RUN_HISTORY = (
    "id BIGINT, run_id STRING, dag_id STRING, execution_date DATE, tickers STRING, "
    "total_articles INT, status STRING, error_message STRING, started_at TIMESTAMP, "
    "completed_at TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP"
)
FILE_METADATA = (
    "id BIGINT, file_type STRING, ticker STRING, file_date DATE, s3_bucket STRING, "
    "s3_key STRING, file_size_bytes BIGINT, row_count INT, uploaded_at TIMESTAMP, "
    "created_at TIMESTAMP"
)
HISTORY_SCHEMAS = {
    "crawling_history": CRAWLING_HISTORY,
    "analysis_history": ANALYSIS_HISTORY,
    "dag_run_history": DAG_RUN_HISTORY,
    "s3_file_metadata": FILE_METADATA,
}
